"""N-gram Jaccard join by chosen paths.

A text is the set of its word shingles. In each of several runs every set picks a few of its
tokens by a hash that all sets share, so that similar sets pick the same ones, and goes to
the bucket of each. Buckets that are still large split again by further picks; small ones
are compared pair by pair. Runs are repeated until a link is missed no more often than asked.

The buckets work on a sketch of each set, its tokens of smallest hash, and only gather texts
that may be linked. Whether two texts are linked is then decided on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.arrow_text import mix, range_hashes, text_runs, window_hashes, words_of
from fleetmeter.llm.components import components
from fleetmeter.llm.stored import stored
from fleetmeter.workers import map_batches

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
SKETCH = 64
PICKS = 1.25  # 1 / similarity: a linked pair shares one pick a level on average
LEVELS = 3
SMALL_BUCKET = 4096  # compared in one task; a bucket that stays larger, block by block
BLOCK_SHINGLES = 1_000_000  # of a group's sets at once in memory: 8 MB
# Of a linked pair, sketches share at least this part but for one case in 100,000.
SKETCH_SHARE = 0.5


def runs_needed(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs after which a linked pair has met with probability ``recall``.

    Shared picks of a level are Poisson with mean one, so a pair gets through a level with
    1 - 1/e, and through one more with 1 - exp(-p) of the chance p to get through the rest.
    """
    through = 1.0
    for _ in range(levels):
        through = 1 - math.exp(-through)
    return math.ceil(math.log(1 - recall) / math.log(1 - through))


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles.

    A text of fewer words has one shingle of them all; one without words but with other
    characters than white space has one of its trimmed bytes; else there is none.
    """
    for run in text_runs(column):
        words = words_of(run)
        edge = words.per_row(run.rows).tolist()
        shingles = window_hashes(words.key, width)
        for i in range(run.rows):
            a, b = edge[i], edge[i + 1]
            if b - a >= width:
                yield np.unique(shingles[a : b - width + 1])
            elif b > a:
                yield mix(window_hashes(words.key[a:b], b - a) + np.uint64(b - a))
            else:
                text = run.data[run.edges[i] : run.edges[i + 1]].tobytes().strip()
                data = np.frombuffer(text, np.uint8)
                whole = np.array([0]), np.array([len(data)])
                yield range_hashes(data, *whole) if len(data) else np.zeros(0, np.uint64)


def _threshold(picks: float, size: int) -> np.uint64:
    return np.uint64(min(2**64 - 1, int(picks / max(size, 1) * 2**64)))


def _picked(sketch: np.ndarray, nodes: np.ndarray, picks: float) -> np.ndarray:
    """The buckets that a set goes to from each of the nodes."""
    hashes = mix(sketch[None, :] ^ nodes[:, None])
    node, token = np.nonzero(hashes <= _threshold(picks, len(sketch)))
    return np.unique(mix(mix(nodes[node]) + sketch[token]))


SIGNATURE = "id long, class_high long, class_low long, size int, sketch binary, paths array<long>"


def _signatures(documents: DataFrame, width: int, runs: int, picks: float, k: int) -> DataFrame:
    """Per document its set's identity, size and sketch, and its buckets of the first level."""
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, sizes, sketches, paths = [], [], [], [], []
            for tokens in shingle_sets(batch.column("text"), width):
                sketch = mix(tokens[:k]).astype(np.uint32)
                identity = _identity(tokens)
                high.append(identity[0])
                low.append(identity[1])
                sizes.append(len(tokens))
                sketches.append(sketch.tobytes())
                paths.append(_picked(sketch.astype(np.uint64), roots, picks).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    pa.array(paths, pa.list_(pa.int64())),
                ],
                names=["id", "class_high", "class_low", "size", "sketch", "paths"],
            )

    return map_batches(documents, sign, SIGNATURE)


def _split(large: DataFrame, picks: float) -> DataFrame:
    """Rows of large buckets in the buckets of the next level."""

    def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("path").to_numpy(zero_copy_only=False).view(np.uint64)
            ids, sketches = batch.column("id").to_pylist(), batch.column("sketch").to_pylist()
            rows, paths = [], []
            for i, data in enumerate(sketches):
                sketch = np.frombuffer(data, np.uint32).astype(np.uint64)
                found = _picked(sketch, nodes[i : i + 1], picks)
                rows += [ids[i]] * len(found)
                paths.append(found.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(paths) if paths else [], pa.int64()),
                    pa.array(rows, pa.int64()),
                ],
                names=["path", "id"],
            )

    return map_batches(large.select("path", "id", "sketch"), deeper, "path long, id long")


class _Union:
    """Links found so far in one task, as trees."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.above.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.above[y] = x
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)

    def edges(self) -> Iterator[pa.RecordBatch]:
        nodes = list(self.above)
        roots = [self.root(x) for x in nodes]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"]
        )


def _groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[dict[str, list]]:
    """Consecutive rows of equal keys, by column; only one group is held."""
    held: dict[str, list] = {}
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        turns = np.zeros(batch.num_rows, dtype=bool)
        for c in keys:
            values = np.asarray(columns[c])
            turns[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(turns).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            now = tuple(columns[c][a] for c in keys)
            if now != last:
                if held:
                    yield held
                held, last = {c: [] for c in columns}, now
            for c, values in columns.items():
                held[c] += values[a:b]
    if held:
        yield held


def _sketch_links(found: _Union, ids: list[int], sketches: list[bytes], side: np.ndarray) -> None:
    """Links all pairs of a bucket whose sketches share enough; of two blocks, across them."""
    first = found.root(ids[0])
    if all(found.root(x) == first for x in ids[1:]):
        return
    tokens = [np.frombuffer(s, np.uint32) for s in sketches]
    size = np.array([len(t) for t in tokens])
    if len(ids) == 2:
        if len(np.intersect1d(*tokens)) >= SKETCH_SHARE * size.max():
            found.link(*ids)
        return
    begins = np.concatenate([[0], np.cumsum(size)[:-1]])
    _, code = np.unique(np.concatenate(tokens), return_inverse=True)
    marked = np.zeros(code.max() + 1, dtype=bool)
    crossing = side.any() and not side.all()
    for i in range(len(ids) - 1):
        if crossing and side[i]:
            continue
        own = code[begins[i] : begins[i] + size[i]]
        marked[own] = True
        if crossing:
            shared = np.add.reduceat(marked[code], begins, dtype=np.int32)
            near = (shared >= SKETCH_SHARE * np.maximum(size, size[i])) & side
            for j in np.flatnonzero(near).tolist():
                found.link(ids[i], ids[j])
        else:
            at = begins[i + 1]
            shared = np.add.reduceat(marked[code[at:]], begins[i + 1 :] - at, dtype=np.int32)
            near = shared >= SKETCH_SHARE * np.maximum(size[i + 1 :], size[i])
            for j in np.flatnonzero(near).tolist():
                found.link(ids[i], ids[i + 1 + j])
        marked[own] = False


def _compare_buckets(leaves: DataFrame) -> DataFrame:
    """Candidate links of buckets: for each task a forest over the documents that it links."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Union()
        for group in _groups(batches, ["path", "first", "second"]):
            if len(group["id"]) > 1:
                side = np.array(group["side"], dtype=bool)
                _sketch_links(found, group["id"], group["sketch"], side)
        yield from found.edges()

    return map_batches(leaves, compare, "a long, b long")


def _paired_blocks(rows: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its block is in: ``first``, ``second`` and
    ``side``, whether it is of the second one. With one block, the row as it is."""
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col(blocks)).cast("int")
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
        .withColumn("first", F.least("_own", "_other"))
        .withColumn("second", F.greatest("_own", "_other"))
        .withColumn("side", F.col("_own") > F.col("_other"))
        .drop("_own", "_other")
    )


def _candidates(sketches: DataFrame, picks: float, levels: int) -> DataFrame:
    """Links between sets whose sketches are alike and that met in some bucket."""
    rows = sketches.select(F.explode("paths").alias("path"), "id")
    sketch = sketches.select("id", "sketch")
    leaves = None
    for level in range(1, levels + 1):
        counts = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        met = rows.join(counts, "path").join(sketch, "id")
        met = stored(met.select("path", "id", "n", "sketch"), "buckets")
        small = met if level == levels else met.where(F.col("n") <= SMALL_BUCKET)
        leaves = small if leaves is None else leaves.union(small)
        large = met.where(F.col("n") > SMALL_BUCKET)
        if level == levels or large.isEmpty():
            break
        rows = _split(large, picks)
    blocks = leaves.withColumn("blocks", F.ceil(F.col("n") / SMALL_BUCKET)).drop("n")
    paired = _paired_blocks(blocks, "blocks").drop("blocks")
    keys = ["path", "first", "second"]
    return _compare_buckets(paired.repartition(*keys).sortWithinPartitions(*keys))


SETS = """root long, blocks long, id long, class_high long, class_low long, copies long,
          tokens binary"""
LINKED = "class_high long, class_low long, id long, links long, near long"


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    """Two sums over the tokens that only equal sets share."""
    high, low = mix(tokens), mix(tokens ^ np.uint64(1))
    return tuple(int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (high, low))


def _sets(members: DataFrame, width: int) -> DataFrame:
    """The whole shingle set of each group member, from the rows of its id."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        last = None
        for batch in batches:
            ids = batch.column("id").to_pylist()
            high = batch.column("class_high").to_pylist()
            low = batch.column("class_low").to_pylist()
            kept, tokens = [], []
            for i, found in enumerate(shingle_sets(batch.column("text"), width)):
                if ids[i] != last:
                    seen, last = set(), ids[i]
                identity = _identity(found)
                # Other texts of the id, and repeated rows of it.
                if identity == (high[i], low[i]) and identity not in seen:
                    seen.add(identity)
                    kept.append(i)
                    tokens.append(found.tobytes())
            out = batch.drop_columns(["text"]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(tokens, pa.binary())], names=[*out.schema.names, "tokens"]
            )

    columns = ["root", "blocks", "id", "class_high", "class_low", "copies", "text"]
    return map_batches(members.select(*columns), read, SETS)


def _exact_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Within each group and pair of blocks, the links of each set, copies counted, and the
    smallest id that it hangs together with there."""
    per_mille = round(similarity * 1000)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "first", "second"]):
            rows = list(
                {
                    (h, l): i for i, (h, l) in enumerate(zip(group["class_high"], group["class_low"]))
                }.values()
            )
            if len(rows) < 2:
                continue
            ids = [group["id"][i] for i in rows]
            weight = np.array([group["copies"][i] for i in rows])
            side = np.array([group["side"][i] for i in rows], dtype=bool)
            crossing = group["first"][0] != group["second"][0]
            if crossing and (side.all() or not side.any()):
                continue  # the other block is empty; links inside this one have their own pair
            tokens = [np.frombuffer(group["tokens"][i], np.uint64) for i in rows]
            size = np.array([len(t) for t in tokens])
            begins = np.concatenate([[0], np.cumsum(size)[:-1]])
            _, code = np.unique(np.concatenate(tokens), return_inverse=True)
            marked = np.zeros(code.max() + 1, dtype=bool)
            links, found = np.zeros(len(ids), dtype=np.int64), _Union()
            for i in range(len(ids)):
                low = 0 if crossing else i + 1
                if low == len(ids) or crossing and side[i]:
                    continue
                own = code[begins[i] : begins[i] + size[i]]
                marked[own] = True
                at = begins[low]
                shared = np.add.reduceat(marked[code[at:]], begins[low:] - at, dtype=np.int64)
                marked[own] = False
                near = shared * 1000 >= per_mille * (size[low:] + size[i] - shared)
                if crossing:
                    near &= side
                near = np.flatnonzero(near) + low
                links[i] += weight[near].sum()
                links[near] += weight[i]
                for j in near.tolist():
                    found.link(ids[i], ids[j])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group["class_high"][i] for i in rows], pa.int64()),
                    pa.array([group["class_low"][i] for i in rows], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(links, pa.int64()),
                    pa.array([found.root(x) for x in ids], pa.int64()),
                ],
                names=["class_high", "class_low", "id", "links", "near"],
            )

    return map_batches(sets, compare, LINKED)


def jaccard_join(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``documents`` that has an id:

    - its id, under its name;
    - ``text_class``: the smallest id with the same shingle set;
    - ``class_id``: the smallest id that it hangs together with over links of at least
      ``similarity``, copies included;
    - ``n_links``: the other rows that it is linked to, copies included.

    A text without shingles, null or white space only, has no links and is its own class.
    Rows without id are left out, as a link could not name them. Repeated rows are copies of
    each other. Different texts of one id have a row each, with the class of each text; those that
    no smaller id has are of one class, as the id names them all. Ids are whole numbers.

    Of each shingle set one document goes into the search, so that copies cost nothing. Links
    between different sets are all counted, but never written out as pairs: each task keeps a
    forest of those it finds.
    """
    key = ["class_high", "class_low", "size"]
    rows = documents.where(F.col(id_column).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(_signatures(rows, width, runs_needed(recall), PICKS, SKETCH), "signatures")

    sets = signed.where("size > 0").groupBy(*key)
    sets = sets.agg(
        F.min("id").alias("id"),
        F.count("*").alias("copies"),
        F.first("sketch").alias("sketch"),
        F.first("paths").alias("paths"),
    )
    sets = stored(sets, "sets")
    groups = components(_candidates(sets.select("id", "sketch", "paths"), PICKS, LEVELS))

    members = groups.withColumnRenamed("node", "id").join(sets.drop("sketch", "paths"), "id")
    total = members.groupBy("root").agg(
        F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("blocks")
    )
    members = stored(members.join(total, "root").drop("size"), "members")
    # Merged at any size: with a broadcast of few members, what a larger table needs would not show.
    texts = rows.hint("merge").join(members, "id")
    whole = _paired_blocks(_sets(texts, width), "blocks").drop("blocks")
    place = ["root", "first", "second"]
    linked = _exact_links(whole.repartition(*place).sortWithinPartitions(*place), similarity)
    linked = stored(linked, "linked")

    roots = components(linked.select("id", "near").where("id != near"))
    counts = linked.groupBy("class_high", "class_low").agg(F.sum("links").alias("links"))
    classes = sets.drop("sketch", "paths").join(counts, ["class_high", "class_low"], "left")
    classes = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        *key,
        F.col("id").alias("text_class"),
        F.coalesce("root", "id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return signed.select("id", *key).join(classes, key, "left").select(
        F.col("id").alias(id_column),
        F.coalesce("text_class", "id").alias("text_class"),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
