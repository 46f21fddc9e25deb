import pyarrow as pa

from kinloom.llm import audio


def test_documents_go_through_tensors(monkeypatch):
    made, make = [], audio.tensors
    monkeypatch.setattr(audio, "tensors", lambda values: made.append(make(values)) or made[-1])
    payload, n = audio.padded("abc " * 9000)
    media = audio.store(payload)
    patches = audio._rows("", media, n)[1]
    audio.digest("", media, n)
    assert len(made) == 2 and all(isinstance(x, pa.FixedShapeTensorArray) and x.type.shape == [audio.PATCH, audio.MELS] and len(x) == len(patches) for x in made)
    assert make([p["mel"] for p in patches]).equals(made[0])
