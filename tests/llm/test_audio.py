import io
import wave

import numpy as np
import pyarrow as pa

from kinloom.llm import audio, queries

from .conftest import odd_texts


def test_files_are_lossless_and_standard():
    for t in odd_texts():
        payload, n = audio.padded(t)
        assert len(payload) % 64 == 0 and payload[:n] == t.encode() and not payload[n:].strip(b"\0")
        media = audio.store(payload)
        assert audio.load(media) == (8000, payload)
        with wave.open(io.BytesIO(media)) as w:
            assert w.readframes(w.getnframes()) == payload


def test_resampling_equals_stuffing_zeros_and_filtering():
    x = np.random.default_rng(0).normal(size=999).astype(np.float32)
    h = audio.phases(5, 8, 16)[:, ::-1].T.reshape(-1)
    stuffed = np.zeros(len(x) * 5)
    stuffed[::5] = x
    full = np.convolve(stuffed, h)
    own = audio.resample(x)
    assert np.allclose(own, full[: len(x) * 5 : 8][: len(own)], atol=1e-4)


def test_a_tone_lands_in_its_band():
    t = np.arange(8000) / 8000
    mel = audio.log_mel(audio.resample(np.sin(2 * np.pi * 1000 * t).astype(np.float32)), 5000)
    bank = audio.filterbank(5000)
    assert mel[5].argmax() == bank[np.abs(np.fft.rfftfreq(256, 1 / 5000) - 1000).argmin()].argmax()


def test_segments_have_hysteresis():
    level = lambda *db: np.log10(np.tile(10 ** (np.array(db) / 10)[:, None] / 32, (1, 32)))
    mel = level(0, 10, 10, 5, 5.2, 10, 0, 0)
    assert audio.segments(mel) == [(1, 6)]
    assert audio.segments(level(3, 3, 3)) == []


def slow_mel(x, rate):
    """Log-mel by definition: one frame, one frequency and one triangle at a time."""
    frames = max(1, -(-(len(x) - audio.FRAME) // audio.HOP) + 1)
    hz = lambda m: 700 * (10 ** (m / 2595) - 1)
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = [hz(top * k / (audio.MELS + 1)) for k in range(audio.MELS + 2)]
    out = np.empty((frames, audio.MELS))
    n = np.arange(audio.FRAME)
    for f in range(frames):
        part = np.zeros(audio.FRAME)
        own = x[f * audio.HOP : f * audio.HOP + audio.FRAME]
        part[: len(own)] = own
        part *= 0.5 - 0.5 * np.cos(2 * np.pi * n / audio.FRAME)
        power = [abs((part * np.exp(-2j * np.pi * k * n / audio.FRAME)).sum()) ** 2 for k in range(audio.FRAME // 2 + 1)]
        for m, (a, b, c) in enumerate(zip(edges, edges[1:], edges[2:])):
            weigh = lambda hz, a=a, b=b, c=c: max(0.0, min((hz - a) / (b - a), (c - hz) / (c - b)))
            out[f, m] = np.log10(sum(p * weigh(k * rate / audio.FRAME) for k, p in enumerate(power)) + audio.FLOOR)
    return out


def slow_segments(mel):
    loud = [10 * np.log10(sum(10.0**v for v in row)) for row in mel]
    mean, on, out = sum(loud) / len(loud), False, []
    for i, x in enumerate([*loud, float("-inf")]):
        if not on and i < len(loud) and x - mean >= audio.BEGINS:
            on, first = True, i
        elif on and x - mean < audio.ENDS:
            on = False
            out.append((first, i))
    return out


def test_features_by_definition():
    """Patches, spans and segments of whole files; loudness near a level may fall to either side."""
    for t in ("", "ab" * 300, "Silence   then  WORDS " * 40, "\x01\x7f" * 500 + "a" * 900):
        media = audio.store(audio.padded(t)[0])
        p, spans, loud = audio.features(media)
        x = audio.resample((np.frombuffer(audio.load(media)[1], np.uint8).astype(np.float32) - 128) / 128).astype(float)
        mel = slow_mel(x, 5000)
        whole = p.reshape(-1, audio.MELS)
        assert np.allclose(whole[: len(mel)], mel, atol=2e-3) and np.allclose(whole[len(mel) :], np.log10(audio.FLOOR))
        assert len(p) == len(spans) == -(-len(mel) // audio.PATCH) and spans[0][0] == 0
        ms = 1000 * audio.HOP / 5000
        assert loud == [(round(a * ms, 3), round((b + 1) * ms, 3)) for a, b in slow_segments(mel)]


def test_operator_and_tensors(spark, make_docs):
    docs = make_docs([(0, None), (1, "abc " * 9000), (2, "abc " * 9000), (None, "x")]).selectExpr("*", "1 as media")
    rows = {r.doc_id: r for r in audio.media_columns(docs).collect()}
    assert len(rows) == 4 and rows[1].patches == rows[2].patches and rows[1].media == rows[2].media
    arr = audio.tensors([p.mel for p in rows[1].patches])
    assert isinstance(arr, pa.FixedShapeTensorArray) and arr.type.shape == [audio.PATCH, audio.MELS] and len(arr) > 1
    assert rows[1].patches[0].start_ms == 0 and rows[1].patches[-1].end_ms > rows[1].patches[0].end_ms
    assert audio.media_columns(make_docs([])).collect() == []


def test_query(spark, tmp_path, make_docs):
    make_docs([*enumerate(odd_texts()), (77, None), (78, "")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op5_audio_features(spark, str(tmp_path)).collect()}
    assert rows[77].payload_bytes == 64 and rows[77].n_bytes == 0 and rows[77].feature == rows[78].feature
