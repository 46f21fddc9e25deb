"""N-gram Jaccard join by chosen paths.

Texts with the same set of word shingles form a class; only classes are joined. A set goes down a tree
from the root of each run: at a node it follows each of its shingles whose hash at that node is below
1/(t n), so it has 1/t followers on average, and two sets of similarity t or more go on together as
often as not at any depth. Nodes that few sets reach are compared by brute force; fuller ones are
split further, and what stays full is compared in blocks. Runs are repeated until the target recall.

Which path a set takes depends on the set and the node alone, so each document finds its own paths;
only (path, class) numbers are shuffled to see which paths meet, and sets travel to those alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import FILE_ROWS, documents, map_batches, map_chunks, schema_of, written
from .fingerprints import mixed, shingle_hashes

SIMILARITY, WIDTH, DEPTH, DEEPER, SPLITS, ROUNDS, BLOCK, RECALL = 0.8, 5, 3, 2, 10, 4, 2048, 0.9999
EMPTY = 0
#: Bins of a sketch, and by how many standard deviations fewer bins may be equal than similar sets have on average:
#: one pair in some hundred millions has fewer, whatever the similarity asked for.
BINS, DEVIATIONS = 64, 6.0
#: Documents in a file of the filtered table, about 15 MB.
FILE_DOCUMENTS = 4000
#: 64-bit words of the bitmap of ids whose texts are wanted; it spares work and decides nothing.
BITMAP = 1 << 18
#: Comparing two sets alone costs as much as so many cells of a matrix product.
ALONE = 20_000
_ODD = np.uint64(0xFF51AFD7ED558CCD)


def met(levels: int) -> float:
    """How likely a pair at the threshold is still together ``levels`` down: it goes on with a Poisson number (mean 1) of shared followers at each."""
    p = 1.0
    for _ in range(levels):
        p = 1 - math.exp(-p)
    return p


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, even if every node on its way is full in each round of splitting."""
    through = (1 - (1 - met(DEEPER)) ** SPLITS) ** ROUNDS
    return math.ceil(math.log(1 - recall) / math.log(1 - met(depth) * through))


def least_equal(either: np.ndarray, similarity: float) -> np.ndarray:
    """How many bins of similar sets are equal at least, of those that either has something in."""
    return either * similarity - DEVIATIONS * np.sqrt(either * similarity * (1 - similarity)) - 1e-9


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def class_of(tokens: np.ndarray) -> int:
    """A number for the set; the same for equal sets, 0 for the empty one. Two sets of many billions may share one by chance."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) if len(tokens) else EMPTY


def sketch_of(tokens: np.ndarray) -> bytes:
    """One byte for each bin of the hash space: of the least shingle there, 0 if there is none."""
    out = np.zeros(BINS, np.uint8)
    bins, first = np.unique((tokens >> np.uint64(58)).astype(np.int64), return_index=True)
    out[bins] = 1 + (tokens[first] % np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def follow(tokens: np.ndarray, nodes: np.ndarray, depth: int, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """The nodes ``depth`` levels below ``nodes`` that the set comes to, and from which of them each comes."""
    origin = np.arange(len(nodes))
    if not len(tokens):
        return nodes[:0], origin[:0]
    below = np.uint64(min(2**64 - 1, int(2**64 / (similarity * len(tokens)))))
    step = max(1, 2_000_000 // len(tokens))
    for _ in range(depth):
        rows, cols = [], []
        for at in range(0, len(nodes), step):
            h = tokens[None, :] ^ nodes[at : at + step, None]
            h *= _ODD
            r, c = np.divmod(np.flatnonzero(h <= below), len(tokens))
            rows.append(r + at)
            cols.append(c)
        if not rows:
            break
        r, c = np.concatenate(rows), np.concatenate(cols)
        nodes, origin = mixed(nodes[r] * np.uint64(0x9E3779B97F4A7C15) + tokens[c]), origin[r]
    return nodes, origin


def roots(runs: int) -> np.ndarray:
    return mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _strips(n: int) -> list[slice]:
    return [slice(at, min(n, at + 128)) for at in range(0, n, 128)]


def _similar(sets: list[np.ndarray], asked: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs asked for are similar, by exact counting: one by one, or if they are many in a matrix of the shingles that any two sets share."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    near = lambda shared, rows: shared >= similarity * (sizes[rows, None] + sizes[None] - shared) - 1e-9
    for rows in _strips(n):
        asked[rows] &= near(np.minimum(sizes[rows, None], sizes[None]), rows)  # the smaller set may lie within the larger
    out, pairs = np.zeros((n, n), bool), int(np.triu(asked, 1).sum())
    if not pairs:
        return out
    found, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    wide = int((times > 1).sum())
    if pairs <= 8 or pairs * ALONE <= float(n) * n * wide / 4:
        for i, j in np.argwhere(np.triu(asked, 1)).tolist():
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            out[i, j] = out[j, i] = shared >= similarity * (sizes[i] + sizes[j] - shared) - 1e-9
        return out
    owner, kept = np.repeat(np.arange(n), sizes.astype(int)), times[where] > 1
    column, owner = (np.cumsum(times > 1) - 1)[where[kept]], owner[kept]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float32)  # counts below 2**24 are exact
    for at in range(0, wide, 2048):
        x, y = np.searchsorted(column, [at, at + 2048])
        m = np.zeros((n, min(2048, wide - at)), np.float32)
        m[owner[x:y], column[x:y] - at] = 1
        for rows in _strips(n):
            both[rows] += m[rows] @ m.T
    for rows in _strips(n):
        out[rows] = asked[rows] & near(both[rows].astype(np.float64), rows)
    return out


def _elsewhere(paths: list[np.ndarray], here: int) -> np.ndarray:
    """Pairs that also meet at a path with a lower number, where they are counted instead."""
    n = len(paths)
    lower = [p[p < here] for p in paths]
    found, where, times = np.unique(np.concatenate(lower), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(p) for p in lower])
    kept = times[where] > 1
    column, owner = (np.cumsum(times > 1) - 1)[where[kept]], owner[kept]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), bool)
    for at in range(0, int((times > 1).sum()), 2048):
        x, y = np.searchsorted(column, [at, at + 2048])
        m = np.zeros((n, int(column[y - 1]) - at + 1), np.float32)
        m[owner[x:y], column[x:y] - at] = 1
        for rows in _strips(n):
            out[rows] |= (m[rows] @ m.T) > 0
    return out


def compare(path: int, i: int, j: int, blocks: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], paths: list[np.ndarray], similarity: float) -> list[tuple[int, int, int]]:
    """(class, links, least class of its component here) for the members that have links which count here."""
    if len(sets) < 2:
        return []
    asked = ~_elsewhere(paths, path)
    if i != j:
        asked &= blocks[:, None] != blocks[None]
    np.fill_diagonal(asked, False)
    near = _similar(sets, asked, similarity)
    if not near.any():
        return []
    label = classes.copy()
    while True:
        new = label.copy()
        for rows in _strips(len(label)):
            new[rows] = np.minimum(label[rows], np.where(near[rows], label[None], np.iinfo(np.int64).max).min(1))
        if (new == label).all():
            break
        label = new
    return [(int(c), int(n), int(m)) for c, n, m in zip(classes, near.sum(1), label) if n]


def promising(i: int, j: int, blocks: np.ndarray, sizes: np.ndarray, sketches: list[bytes], elsewhere: np.ndarray, similarity: float) -> np.ndarray:
    """The members that have a partner of fitting size and sketch with whom they don't also meet elsewhere."""
    n = len(sizes)
    marks = np.frombuffer(b"".join(sketches), np.uint8).reshape(n, BINS)
    out, sizes = np.zeros(n, bool), sizes.astype(np.float64)
    for at in range(0, n, 32):
        rows = slice(at, min(n, at + 32))
        a, b = marks[rows, None, :], marks[None]
        equal, either = ((a == b) & (a > 0)).sum(2), ((a > 0) | (b > 0)).sum(2)
        fit = (equal >= least_equal(either, similarity)) & (np.minimum(sizes[rows, None], sizes[None]) >= similarity * np.maximum(sizes[rows, None], sizes[None]) - 1e-9)
        fit &= ~elsewhere[rows]
        if i != j:
            fit &= blocks[rows, None] != blocks[None]
        fit[np.arange(rows.stop - at), np.arange(at, rows.stop)] = False
        out[rows] |= fit.any(1)
    return out


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that are sorted by their first columns, group by group; a group may go on in the next batch."""
    now, group = None, []
    for batch in batches:
        for row in zip(*(x.to_pylist() for x in batch.columns)):
            if row[:keys] != now:
                if group:
                    yield now, group
                now, group = row[:keys], []
            group.append(row[keys:])
    if group:
        yield now, group


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def class_table(docs: DataFrame, runs: int, width: int, similarity: float) -> DataFrame:
    """doc_id, class, size, sketch, paths for every row."""

    def make():
        start = roots(runs)

        def one(batch):
            classes, sizes, sketches, paths = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(t, width)
                classes.append(class_of(s))
                sizes.append(len(s))
                sketches.append(sketch_of(s))
                paths.append(np.unique(_signed(follow(s, start, DEPTH, similarity)[0])))
            return [batch.column(0), classes, sizes, sketches, paths]

        return one

    return map_chunks(docs, make, "doc_id long, class long, size long, sketch binary, paths array<long>")


def _met(reached: DataFrame) -> DataFrame:
    """path, members of the paths where classes meet; of paths with the same members one stays."""
    by_path = reached.groupBy("path").agg(F.count(F.lit(1)).alias("members"), F.sum(F.shiftright(F.xxhash64("class"), 20)).alias("a"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("b")).where("members > 1")
    return by_path.groupBy("members", "a", "b").agg(F.min("path").alias("path")).select("path", "members")


def marked(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which every id of ``ids`` is marked. Ids by the billion fill it, and then it spares nothing."""
    place = f"pmod(xxhash64(doc_id), {64 * BITMAP})"
    words = ids.where("doc_id is not null").groupBy(F.expr(f"{place} div 64").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({place} % 64 as int))")).alias("bits")).collect()
    bitmap = np.zeros(BITMAP, np.int64)
    for r in words:
        bitmap[r.word] = r.bits
    return bitmap


def join_classes(docs: DataFrame, table: DataFrame, width: int, similarity: float) -> DataFrame:
    """class, links, root (a lower or equal class in the same component), once for each path and class."""
    spark = docs.sparkSession
    ones = table.where("size > 0").groupBy("class").agg(F.first("paths").alias("paths"))
    n = ones.count()
    reached = written(ones.select("class", F.explode("paths").alias("path")), "paths", 40 * n)
    met = written(_met(reached), "paths-met", n)
    members = written(reached.join(met.hint("merge"), "path"), "path-members", 20 * n)  # alike at every size: paths are dealt by path either way

    meeting = written(members.select("class").distinct().join(table.groupBy("class").agg(F.min("doc_id").alias("doc_id")), "class"), "classes-met", n)
    shared = spark.sparkContext.broadcast(marked(meeting))

    def sets():
        bits = shared.value.view(np.uint64)

        def one(batch):
            at = batch.column(0).to_numpy(zero_copy_only=False)
            wanted = np.flatnonzero((at < 0) | ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1))
            found = [shingle_set(t, width) for t in batch.column(1).take(pa.array(wanted)).to_pylist()]
            return [[class_of(s) for s in found], [s.tobytes() for s in found]]

        return one

    placed = docs.select(F.coalesce(F.when(F.col("doc_id").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(64 * BITMAP))), F.lit(-1)).alias("place"), "text")
    whole = map_chunks(placed, sets, "class long, tokens binary").join(meeting.select("class"), "class")
    whole = written(whole.groupBy("class").agg(F.first("tokens").alias("tokens")), "class-sets")

    for _ in range(ROUNDS):
        full = members.where(F.col("members") > BLOCK)
        if full.isEmpty():
            break

        def split():
            def one(batch):
                out_class, out_path = [], []
                for c, path, tokens in zip(*(x.to_pylist() for x in batch.columns)):
                    below = follow(np.frombuffer(tokens, np.uint64), np.array([path], np.int64).view(np.uint64), DEEPER, similarity)[0]
                    out_class += [c] * len(below)
                    out_path += _signed(below).tolist()
                return [out_class, out_path]

            return one

        # a pair at a node goes on together once on average only, so a full node is entered as often as makes up for it
        again = full.select("class", "path", F.explode(F.sequence(F.lit(1), F.lit(SPLITS))).alias("turn")).select("class", F.xxhash64("path", "turn").alias("path"))
        stays = full.count()
        # sets meet their nodes in all tasks; only the narrow rows that come of it are dealt to few files
        below = map_chunks(again.join(whole, "class").select("class", "path", "tokens"), split, "class long, path long")
        below = written(below.repartition(-(-10 * stays // FILE_ROWS)), "paths-below")
        met_below = written(_met(below), "paths-met-below", stays)
        deeper = below.join(met_below, "path").select("path", "class", "members")
        if deeper.where(F.col("members") > BLOCK).agg(F.count(F.lit(1)).alias("n")).first().n >= stays:
            break  # what is full is full of similar sets: splitting it further only repeats it
        members = written(members.where(F.col("members") <= BLOCK).select("path", "class", "members").unionByName(deeper), "path-members", 20 * n)

    at = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")).cast("int"))
    dealt = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("path", "class", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("path", "i", "j", "class")

    # first by sketches alone, so that sets travel only to where a link of theirs would be counted
    about = table.where("size > 0").groupBy("class").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    own = members.groupBy("class").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    sketched = dealt.join(about.join(own, "class"), "class").select("path", "i", "j", "block", "class", "size", "sketch", "paths")
    alive_schema = schema_of(spark, "path long, i int, j int, block int, class long")

    def pick_alive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out = to_arrow_schema(alive_schema), []
        for (path, i, j), group in grouped(batches, 3):
            if len(group) > 1:
                keep = promising(i, j, np.array([g[0] for g in group]), np.array([g[2] for g in group]), [g[3] for g in group], _elsewhere([np.array(g[4], np.int64) for g in group], path), similarity)
                out += [(path, i, j, g[0], g[1]) for g, k in zip(group, keep) if k]
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    alive = map_batches(sketched.repartition(parts, "path", "i", "j").sortWithinPartitions(*order), pick_alive, alive_schema)
    alive = written(alive.repartition(-(-max(1, n) // FILE_ROWS)), "path-alive")
    rows = alive.join(whole.join(own, "class"), "class")
    schema = schema_of(spark, "class long, links long, root long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out = to_arrow_schema(schema), []
        for (path, i, j), group in grouped(batches, 3):
            blocks, classes = np.array([g[0] for g in group]), np.array([g[1] for g in group], np.int64)
            out += compare(path, i, j, blocks, classes, [np.frombuffer(g[2], np.uint64) for g in group], [np.array(g[3], np.int64) for g in group], similarity)
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=arrow)

    return map_batches(rows.select("path", "i", "j", "block", "class", "tokens", "paths").repartition(parts, "path", "i", "j").sortWithinPartitions(*order), run, schema)


def components(edges: DataFrame) -> DataFrame:
    """class, label: the least class of its component. Labels pass along edges and then jump, until none changes."""
    n = 2 * edges.count()
    both = written(edges.select(F.col("class").alias("a"), F.col("root").alias("b")).where("a <> b").unionByName(edges.select(F.col("root").alias("a"), F.col("class").alias("b")).where("a <> b")).distinct(), "edges", n)
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("class"), F.least("a", "m").alias("label")), "labels", n)
    while True:
        least = both.join(labels.select(F.col("class").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        passed = labels.join(least, labels["class"] == least["a"]).select("class", F.least("label", "m").alias("label"), F.col("label").alias("was"))
        passed = written(passed, "labels-passed", n)
        jump = passed.select(F.col("class").alias("label"), F.col("label").alias("further"))
        new = written(passed.join(jump, "label", "left").select("class", F.least("label", "further").alias("label"), "was"), "labels", n)
        if new.where("label <> was").isEmpty():
            return new.select("class", "label")
        labels = new.select("class", "label")


def similarity_join(df: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, copy_id, copies, links, shingles: one row for each row of ``df``.

    ``copy_id`` is the least id of the texts with the same shingles, ``copies`` their number;
    ``links`` how many classes of other texts are similar; ``class_id`` the least id that links lead
    to. Texts without words are copies of one another and similar to none. Ids that are null count
    for none of these; a class of such rows alone has null ids. Repeated rows are copies.
    """
    docs = documents(df, id_col, text_col)
    table = written(class_table(docs, runs_for(recall), width, similarity), "classes")
    rows = table.count()
    found = written(join_classes(docs, table, width, similarity).repartition(-(-max(1, rows) // FILE_ROWS)), "links")
    labels = components(found)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    copies = table.groupBy("class").agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("copies"))
    known = copies.join(links, "class", "left").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    known = written(known, "class-links", rows)
    named = known.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    full = known.join(named, "label").select("class", "class_id", "copy_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return table.select("doc_id", "class", "size").join(full, "class").select("doc_id", "class_id", "copy_id", "copies", "links", F.col("size").alias("shingles"))


def one_of_each(df: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """``df`` (with doc_id, text) with one row of each class of ``similarity_join``: that of the least doc_id.

    Of rows that repeat an id and a text one stays; different texts under one id go or stay together
    by the least class of them. Rows with a null id can't be named, so they stay.
    """
    rows = df.count()
    spread = written(similarity_join(df, similarity, width, recall).where("doc_id is not null").select("doc_id", "class_id"), "near-copies", rows)
    by_id = spread.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    left = df.join(by_id.where("doc_id <> class_id").select("doc_id"), "doc_id", "left_anti").select(df.columns).coalesce(-(-max(1, rows) // FILE_DOCUMENTS))
    repeated = by_id.where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    repeated = written(repeated, "repeated-ids")
    return left.join(repeated, "doc_id", "left_anti").select(df.columns).unionByName(left.join(repeated, "doc_id", "left_semi").select(df.columns).dropDuplicates(["doc_id", "text"]))
