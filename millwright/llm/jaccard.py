"""Near-duplicate texts: a similarity join on sets of word n-grams by prefix trees.

1. A count sketch of all n-grams fixes a global order, rare first. Any order gives the same links; this one keeps common
   passages out of the prefixes. The sketch lies in the shared folder, where tasks read it; the driver never holds it.
2. Texts with equal sets form classes; one representative of each goes on.
3. Two sets that are similar enough share an n-gram among the first ``n - ceil(threshold * n) + 1`` of each. Within every
   shared n-gram, each representative is paired with one centre of like size only, and centres with those of the next sizes.
4. Each pair is checked against the whole sets. The members of a centre are stored as a prefix tree, commonest n-gram
   first; the tree is walked once, overlaps with the centre are shared along paths, and a subtree is left as soon as no
   length between the smallest and largest that remain in it can reach the overlap it needs.
5. Links give components. Only n-grams that still hold different components are looked at again, pair by pair, but a pair
   goes on only if parity bitmaps of both sets allow it, and is then checked by step 4. A set first names its nearest pairs
   only. Sets with pairs left out are looked at again, by finer bitmaps and with more pairs for each, until none is left out;
   most of them are of one component by then. So no link is lost, and a group of copies costs a few pairs for each of them, not all.
   A round's links go on from the components so far, and links inside one component are dropped, so no link is joined in each round again.

Hot n-grams, cells and centres are dealt over as many tasks as their counted size asks for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm import words as W
from millwright.llm.sums import loaded, sliced, stored, tune
from millwright.session import cut

SKETCH = 1 << 21
NEEDED = 1 << 20
#: Rows that one task handles for one n-gram; n-grams of sets that one task holds for one centre; rows of a cell.
SALT_ROWS, BLOCK_GRAMS, CELL_ROWS = 20_000, 2_000_000, 2_000
#: Pairs of other components that a set names in the first round, and how many times more in each further one.
NEAREST, FURTHER = 8, 16
#: Cells of the finer bitmaps of further rounds for each n-gram.
FINE = 4


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(40)).astype(np.int64) & (SKETCH - 1)


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """For each text, the hashes of all its n-grams, repeated ones included."""
    data = W.lower(data)
    starts, ends, first = W.spans(data, offsets, W.SPACED)
    h = W.hashes(data, starts, ends)
    grams = W.windows(h, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield grams[a : b - size + 1] if b - a >= size else W.windows(h[a:b], b - a) if b > a else grams[:0]


def _ordered(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set in the global order, rare first."""
    grams = np.unique(grams)
    return grams[np.lexsort((grams, counts[_cell(grams)]))]


def _parity(grams: np.ndarray, times: int = 1) -> bytes:
    """A bitmap of the parities of the set in a power of two of cells, at least ``times`` as many as n-grams and 64."""
    cells = max(64, 1 << max(0, times * len(grams) - 1).bit_length())
    return np.packbits(np.bincount((grams & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1 == 1, bitorder="little").tobytes()


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sketch_of(documents: DataFrame, text: str, size: int) -> str:
    """The folder of a sketch of how often n-grams occur, in ``SKETCH`` cells; it only orders n-grams, so collisions do no harm."""

    def task(batches):
        total = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for _, _, data, offsets in W.texts(batch.column(0)):
                for grams in _shingles(data, offsets, size):
                    np.add.at(total, _cell(grams), np.uint32(1))
        yield from sliced(total)

    return stored(documents.select(text), task, np.uint32)


def _counts(sketch: str) -> np.ndarray:
    """The sketch, read by a task."""
    return loaded(sketch, (SKETCH,), np.uint32)


def identities(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """id, n, and two sums that identify the set."""

    def task(batches):
        for batch in batches:
            rows = []
            for low, _, data, offsets in W.texts(batch.column(1)):
                for d, grams in enumerate(_shingles(data, offsets, size), low):
                    grams = np.unique(grams)
                    one, two = W.mix(grams).sum(dtype=np.uint64), W.mix(~grams).sum(dtype=np.uint64)
                    rows.append((batch.column(0)[d].as_py(), len(grams), int(one.view(np.int64)), int(two.view(np.int64))))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["id", "n", "s1", "s2"])

    return documents.select(F.col(key).cast("bigint"), text).mapInArrow(task, "id bigint, n int, s1 bigint, s2 bigint")


def representatives(documents: DataFrame, sketch: str, key: str, text: str, size: int, percent: int) -> DataFrame:
    """For each different set: the smallest id as ``rep``, n, the prefix in the global order, and two parity bitmaps. Copies are folded before the shuffle."""

    def task(batches):
        counts = None
        for batch in batches:
            rows = []
            if counts is None and batch.num_rows:
                counts = _counts(sketch)
            for low, _, data, offsets in W.texts(batch.column(1)):
                for d, grams in enumerate(_shingles(data, offsets, size), low):
                    if not len(grams):
                        continue
                    grams = _ordered(grams, counts)
                    one, two = W.mix(grams).sum(dtype=np.uint64), W.mix(~grams).sum(dtype=np.uint64)
                    rows.append((int(one.view(np.int64)), int(two.view(np.int64)), batch.column(0)[d].as_py(), len(grams), grams[: _prefix(len(grams), percent)].tobytes(), _parity(grams), _parity(grams, FINE)))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["s1", "s2", "id", "n", "prefix", "parity", "fine"])

    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), text).mapInArrow(task, "s1 bigint, s2 bigint, id bigint, n int, prefix binary, parity binary, fine binary")
    return rows.groupBy("s1", "s2").agg(F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "prefix", "parity", "fine")))


def _band(n, percent: int):
    """Sizes of linked sets lie in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / (percent - 1)))).cast("int")


def _postings(classes: DataFrame, sketch: str, percent: int) -> DataFrame:
    """A row for each n-gram of a prefix. An n-gram that may be hot is dealt over salts by what the sketch counts above the usual."""

    def task(batches):
        counts = None
        for batch in batches:
            grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
            if not grams:
                continue
            if counts is None:
                counts = _counts(sketch)
                usual = int(np.median(counts))
            lengths = [len(g) for g in grams]
            token, rep, band = np.concatenate(grams), np.repeat(batch.column(0).to_numpy(), lengths), np.repeat(batch.column(1).to_numpy(), lengths)
            parts = -(-(counts[_cell(token)].astype(np.int64) - usual) // SALT_ROWS)
            salt = np.where(parts > 1, (W.mix(rep.astype(np.uint64)) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64) + 1, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(salt), pa.array(band), pa.array(rep)], ["token", "salt", "band", "rep"])

    return classes.select("rep", _band(F.col("n"), percent).alias("band"), "prefix").mapInArrow(task, "token bigint, salt int, band int, rep bigint")


def _starred(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose n-gram others of like size share or may share, and candidate pairs: each row with the first of its band, and
    the firsts of neighbouring bands."""
    group = Window.partitionBy("token", "salt").orderBy("band", "rep")
    band = Window.partitionBy("token", "salt", "band").orderBy("rep")
    rows = postings.select("*", F.lag("band").over(group).alias("before"), F.lead("band").over(group).alias("after"), F.first("rep").over(band).alias("centre"))
    near = (F.col("band") - F.col("before") <= 1) | (F.col("after") - F.col("band") <= 1)
    shared = cut(rows.where(F.coalesce(near, F.lit(False)) | (F.col("salt") > 0)).drop("before", "after"))
    firsts = shared.where("rep = centre").select("token", "salt", "band", "rep")
    next_ = firsts.select("token", "salt", (F.col("band") - 1).alias("band"), F.col("rep").alias("other"))
    across = firsts.join(next_, ["token", "salt", "band"]).select(F.least("rep", "other").alias("centre"), F.greatest("rep", "other").alias("rep"))
    return shared.select("token", "band", "rep"), shared.where("rep <> centre").select("centre", "rep").unionAll(across).distinct()


def _differences(bitmaps: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows, in how many cells their bitmaps differ, the larger folded to the smaller: at most in as many as the sets differ in."""
    lengths = np.array([len(x) for x in bitmaps])
    out, small = np.zeros(len(a), np.int64), np.minimum(lengths[a], lengths[b])
    for size in np.unique(small).tolist():
        own = np.flatnonzero(small == size)
        for at in range(0, len(own), max(1, (1 << 22) // size)):
            some = own[at : at + max(1, (1 << 22) // size)]
            ends = []
            for side in (a[some], b[some]):
                rows, back = np.unique(side, return_inverse=True)
                folded = np.stack([np.bitwise_xor.reduce(bitmaps[r].reshape(-1, size), axis=0) for r in rows.tolist()])
                ends.append(folded[back])
            out[some] = np.bitwise_count(ends[0] ^ ends[1]).sum(axis=1, dtype=np.int64)
    return out


def _may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many n-grams can be similar enough."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((n + m - differ) * (100 + percent) >= 2 * (n + m) * percent)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (centre, rep) that sizes and bitmaps allow."""
    own = classes.select("rep", "n", "parity")
    other = classes.select(F.col("rep").alias("centre"), F.col("n").alias("m"), F.col("parity").alias("q"))

    def test(batches):
        for batch in batches:
            if batch.num_rows:
                n, m = batch.column(2).to_numpy().astype(np.int64), batch.column(4).to_numpy().astype(np.int64)
                bitmaps = [np.frombuffer(x.as_buffer(), np.uint8) for c in (3, 5) for x in batch.column(c)]
                at = np.arange(len(n))
                yield batch.select([0, 1]).filter(pa.array(_may_link(n, m, _differences(bitmaps, at, at + len(n)), percent)))

    return pairs.join(own, "rep").join(other, "centre").select("centre", "rep", "n", "parity", "m", "q").mapInArrow(test, "centre bigint, rep bigint")


class Trie:
    """Sequences in one global order as a prefix tree, kept as its leaves in depth-first order and the depth that each shares with the one before."""

    def __init__(self, names: list[int], sequences: list[np.ndarray]) -> None:
        order = sorted(range(len(names)), key=lambda i: sequences[i].astype(">u8").tobytes())
        self.names, self.sequences = [names[i] for i in order], [sequences[i] for i in order]
        shared = [0] * bool(names)
        for a, b in zip(self.sequences, self.sequences[1:], strict=False):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared.append(int(differ[0]) if len(differ) else m)
        self.shared = np.array(shared, np.int64)
        self.sizes = np.array([len(x) for x in self.sequences], np.int64)

    def _subtree(self, leaf: int, depth: int) -> int:
        """The end of the leaves, from ``leaf`` on, that share its first ``depth`` n-grams."""
        apart = self.shared[leaf + 1 :] < depth
        return leaf + 1 + int(np.argmax(apart)) if apart.any() else len(self.names)

    def matches(self, query: np.ndarray, percent: int, step: int = 128):
        """Names of the sequences whose Jaccard similarity with ``query`` (sorted) is ``percent`` or more, and the overlaps."""
        size = len(query)
        along = np.zeros(1, np.int64)  # along[d]: n-grams of the query among the first d of the path
        leaf = 0
        while leaf < len(self.names):
            sequence = self.sequences[leaf]
            at = min(int(self.shared[leaf]), len(along) - 1)
            parts, total, depth = [along[: at + 1]], int(along[at]), at
            after = leaf + 1
            while depth < len(sequence):
                piece = sequence[depth : depth + step]
                found = np.searchsorted(query, piece)
                counts = np.cumsum(query[np.minimum(found, size - 1)] == piece)
                parts.append(total + counts)
                total, depth = total + int(counts[-1]), depth + len(piece)
                if not _reachable(size, total, depth, len(sequence), len(sequence), percent):
                    # This set cannot; leave the subtree below here too if none of the lengths in it can.
                    end = self._subtree(leaf, depth)
                    own = self.sizes[leaf:end]
                    if _reachable(size, total, depth, int(own.min()), int(own.max()), percent):
                        end = leaf + 1
                    after, total = end, -1
                    break
            along = np.concatenate(parts)
            if total >= 0 and total * (100 + percent) >= percent * (size + len(sequence)):
                yield self.names[leaf], total
            leaf = after


def _reachable(size: int, total: int, depth: int, shortest: int, longest: int, percent: int) -> bool:
    """Whether a set of ``shortest`` to ``longest`` n-grams, ``total`` of its first ``depth`` in a query of ``size``, can be similar enough.

    A set of n more n-grams has at most ``total + min(n, size - total)`` in common; the share of the union grows with n up
    to ``size - total`` and falls beyond, so the best length is the nearest to that within the bounds.
    """
    n = min(max(size - total, shortest - depth), longest - depth)
    overlap = total + min(n, size - total)
    return overlap * (100 + percent) >= percent * (size + depth + n)


def _verified(pairs: DataFrame, sizes: DataFrame, documents: DataFrame, sketch: str, key: str, text: str, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (centre, rep) whose sets are similar enough. ``sizes`` has a row (rep, n) for each ``rep``."""
    pairs = cut(pairs)
    bucket = F.pmod(F.xxhash64("id"), F.lit(NEEDED))
    ends = pairs.select(F.col("centre").alias("id")).unionAll(pairs.select(F.col("rep").alias("id")))
    # One bit for each hash of a needed id, in a bitmap of fixed size: keeps other texts from the shuffle.
    bits = ends.select(bucket.alias("bucket")).selectExpr("cast(bucket div 32 as int) AS at", "shiftleft(1L, cast(bucket % 32 as int)) AS bit")
    needed = np.zeros(NEEDED // 32, np.int64)
    for row in bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        needed[row["at"]] = row["bits"]

    def task(batches):
        counts = None
        for batch in batches:
            at = batch.column(2).to_numpy()
            wanted = (needed[at // 32] >> (at % 32)) & 1 == 1
            if not wanted.any():
                continue
            if counts is None:
                counts = _counts(sketch)
            chosen = batch.filter(pa.array(wanted))
            ids, grams = chosen.column(0).to_pylist(), []
            for _, _, data, offsets in W.texts(chosen.column(1)):
                grams += [_ordered(g, counts)[::-1] for g in _shingles(data, offsets, size)]
            for i in range(0, len(ids), 64):
                part = grams[i : i + 64]
                yield pa.RecordBatch.from_arrays([pa.array(ids[i : i + 64], pa.int64()), pa.array([g.tobytes() for g in part], pa.binary())], ["id", "grams"])

    sets = documents.select(F.col(key).cast("bigint").alias("id"), text).where("id is not null").withColumn("bucket", bucket.cast("int")).mapInArrow(task, "id bigint, grams binary").where("length(grams) > 0")
    blocks = pairs.join(sizes, "rep").groupBy("centre").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).cast("int").alias("blocks"))
    members = pairs.join(blocks, "centre").select("centre", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), F.col("rep").alias("id"))
    centres = blocks.select("centre", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("centre").alias("id"))
    rows = members.withColumn("role", F.lit(1)).unionAll(centres.withColumn("role", F.lit(0))).join(sets, "id")
    ordered = rows.repartition(F.col("centre"), F.col("block")).sortWithinPartitions("centre", "block", "role").select("centre", "block", "role", "id", "grams")

    def walk(batches):
        for (centre, _), table in _chunks(batches, 2, 2):
            role, ids = table.column("role").to_numpy(), table.column("id").to_pylist()
            grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
            members_ = np.flatnonzero(role == 1)
            trie = Trie([ids[i] for i in members_], [grams[i] for i in members_])
            found = sorted({name for i in np.flatnonzero(role == 0) for name, _ in trie.matches(np.sort(grams[i]), percent)})
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([centre] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])

    return cut(ordered.mapInArrow(walk, "a bigint, b bigint"))


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The different pairs of components that ``links`` join; an id without a label is a component of its own."""
    for end in ("a", "b"):
        own = labels.select(F.col("id").alias(end), "component")
        links = links.select("a", "b").join(own, end, "left").withColumn(end, F.coalesce("component", end))
    return cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``id, component`` for every end of a link: the smallest id that links reach. ``labels``, where given, are those of earlier links; all their ids stay.

    Every component takes the label of its smallest neighbour, and labels jump to their label's label until nothing changes.
    Only links that then join different components go on, one for each two, so a link inside a component is not looked at again.
    """
    if labels is None:
        labels = links.select(F.col("a").alias("id"), F.col("a").alias("component")).where(F.lit(False))
    links = _between(links, labels)
    while links.limit(1).count():
        ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut(ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"))
        changed = 1
        while changed:
            jump = near.select(F.col("id").alias("component"), F.col("component").alias("further"))
            after = cut(near.join(jump, "component").select("id", F.col("component").alias("was"), F.col("further").alias("component")))
            changed = after.where("component <> was").limit(1).count()
            near = after.drop("was")
        jump = near.select(F.col("id").alias("component"), F.col("component").alias("further"))
        moved = labels.join(jump, "component", "left").select("id", F.coalesce("further", "component").alias("component"))
        labels = cut(moved.unionAll(near.join(labels, "id", "left_anti")))
        links = _between(links, near)
    return labels


def _across(shared: DataFrame, labels: DataFrame, classes: DataFrame, percent: int, most: int, bitmap: str = "parity") -> tuple[DataFrame, DataFrame]:
    """Pairs of different components that share an n-gram and that sizes and parity bitmaps allow, if among the ``most`` nearest of
    either set by their bitmaps; and the sets, as ``rep``, of the pairs left out."""
    rows = shared.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = F.min("component").alias("low"), F.max("component").alias("high")
    # A cell holds one band of sizes and, as guests, the next. Cells of n-grams with the same first id hold much the same rows and go to one task, which names a pair once.
    rows = rows.select("token", "rep", "component", "band", F.explode(F.array("band", F.col("band") - 1)).alias("cell"))
    cells = rows.groupBy("token", "cell").agg(*mixed, F.count("*").alias("rows"), F.min("rep").alias("first")).where("low <> high")
    # Parts follow the largest cell and the rows of all cells together; a pair falls into the same two parts in every cell, so it is still named once.
    widest, whole = F.ceil(F.max("rows") / CELL_ROWS), F.ceil(F.sqrt(F.sum("rows") / CELL_ROWS))
    parts = cells.groupBy("first").agg(F.greatest(widest, whole).cast("int").alias("parts"))
    cells = cells.join(parts, "first").select("token", "cell", "first", "parts")
    # Large groups are cut into parts, and each pair of parts is a task's work.
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    rows = rows.join(cells, ["token", "cell"]).withColumn("part", part).join(classes.select("rep", "n", F.col(bitmap).alias("parity")), "rep")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "first", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "token", "cell", "n", "rep", "component", "band", "part", "parity")
    # With a number, as the few bytes would else be merged into few tasks for much work.
    tasks = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "first", "i", "j").sortWithinPartitions("first", "i", "j", "token", "cell", "n", "rep")

    def task(batches):
        run, held, left = None, [], []

        def fold():
            found, others = _nearest(np.concatenate(held, axis=1), most)
            held[:], left[:] = [found], [np.unique(np.concatenate([*left, others]))]

        def out():
            fold()
            (low, high, far), sets = held[0], left[0]
            columns = np.concatenate([low, sets]), pa.concat_arrays([pa.array(high), pa.nulls(len(sets), pa.int64())]), np.concatenate([far, np.zeros_like(sets)])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["centre", "rep", "far"])

        for key, table in _chunks(batches, 5, 3):
            if key != run:
                if held:
                    yield out()
                run, held, left = key, [], []
            held.append(_pairs(table, percent))
            if len(held) > 64:
                fold()
        if held:
            yield out()

    # A row without a ``rep`` names a set with pairs left out. A set meets others in several tasks, so its pairs are ranked once more.
    found = cut(ordered.mapInArrow(task, "centre bigint, rep bigint, far bigint").distinct())
    ranks = (F.row_number().over(Window.partitionBy(a).orderBy("far", b)) for a, b in (("centre", "rep"), ("rep", "centre")))
    ranked = cut(found.where("rep IS NOT NULL").withColumn("rank", F.least(*ranks)))
    beyond = ranked.where(F.col("rank") > most)
    left_out = found.where("rep IS NULL").select("centre").unionAll(beyond.select("centre")).unionAll(beyond.select("rep"))
    return ranked.where(F.col("rank") <= most).select("centre", "rep"), cut(left_out.withColumnRenamed("centre", "rep").distinct())


def _nearest(found: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (two sets, how far apart) that are among the ``most`` nearest of either set, and the sets of all others."""
    found = np.unique(found, axis=1)
    near = np.zeros(found.shape[1], bool)
    for own, other in ((0, 1), (1, 0)):
        order = np.lexsort((found[other], found[2], found[own]))
        _, counts = np.unique(found[own], return_counts=True)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
        near[order[rank < most]] = True
    return found[:, near], np.unique(found[:2, ~near])


def _chunks(batches, width: int, outer: int):
    """Whole runs of equal first ``width`` columns, several together where their first ``outer`` columns agree: (these values, table)."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        keys = [table.column(k).to_numpy() for k in range(width)]
        inner, change = np.zeros(len(table), bool), np.zeros(len(table), bool)
        for i, k in enumerate(keys):
            differs = k[1:] != k[:-1]
            inner[1:] |= differs
            if i < outer:
                change[1:] |= differs
        last = int(np.flatnonzero(inner)[-1]) if inner.any() else 0
        cuts = [0, *np.flatnonzero(change[:last]).tolist(), last] if last else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield tuple(int(k[a]) for k in keys[:outer]), table.slice(a, b - a)
        held = table.slice(last)
    if held is not None:
        yield tuple(held.column(k)[0].as_py() for k in range(outer)), held


def _pairs(table: pa.Table, percent: int) -> np.ndarray:
    """The pairs of a chunk and in how many thousandths of both sizes their bitmaps differ: rows of one cell are compared with those
    1, 2, 3, ... places further while any row has one of like size."""
    i, j, token, cell, n, rep, component, band, part = (table.column(c).to_numpy() for c in ("i", "j", "token", "cell", "n", "rep", "component", "band", "part"))
    n = n.astype(np.int64)
    bitmaps = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("parity")]
    mixed = i[0] != j[0]
    at, out = np.arange(len(rep)), [np.zeros((3, 0), np.int64)]
    step = 0
    waiting = []

    def flush():
        a, b = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
        low, high = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
        _, first = np.unique(np.stack([low, high]), axis=1, return_index=True)
        a, b, low, high = a[first], b[first], low[first], high[first]
        differ = _differences(bitmaps, a, b)
        ok = _may_link(n[a], n[b], differ, percent)
        out.append(np.stack([low, high, 1000 * differ // (n[a] + n[b])])[:, ok])
        waiting.clear()

    while True:
        step += 1
        at = at[at + step < len(rep)]
        to = at + step
        at = at[(token[at] == token[to]) & (cell[at] == cell[to]) & (100 * n[at] >= percent * n[to])]
        if not len(at):
            break
        to = at + step
        ok = (component[at] != component[to]) & ((band[at] == cell[at]) | (band[to] == cell[to]))
        if mixed:
            ok &= part[at] != part[to]
        if ok.any():
            waiting.append((at[ok], to[ok]))
            if sum(len(w[0]) for w in waiting) > 200_000:
                flush()
    if waiting:
        flush()
    return np.concatenate(out, axis=1)


def _same_key(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a key: they are one document."""
    several = found.groupBy("id").agg(F.min("s1").alias("low"), F.max("s1").alias("high")).where("low <> high").select("id")
    own = found.select("id", "s1", "s2").join(several, "id").join(classes, ["s1", "s2"]).select("id", "rep").distinct()
    return own.join(own.groupBy("id").agg(F.min("rep").alias("low")), "id").select(F.col("low").alias("a"), F.col("rep").alias("b"))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """``key, n_shingles, component_id`` of every row of ``documents``.

    Words are lower-cased runs between spaces. A text of fewer than ``size`` words has one n-gram, its whole sequence. Texts that are
    null or have no words link with nothing. A null key links with nothing and has a null component; rows of one key count
    as one document. Sets are compared by 64-bit hashes of n-grams.
    """
    tune(documents.sparkSession, 500)
    documents = documents.select(key, text)
    sketch = sketch_of(documents, text, size)
    sets = cut(identities(documents, key, text, size))
    reps = cut(representatives(documents, sketch, key, text, size, percent))
    found, classes = sets.where("n > 0 and id is not null"), reps.select("s1", "s2", "rep")
    args = (cut(reps.groupBy("rep").agg(F.max("n").alias("n"))), documents, sketch, key, text, size, percent)
    shared, star = _starred(_postings(reps, sketch, percent))
    labels = components(_verified(_plausible(star, reps, percent), *args).unionAll(_same_key(found, classes)))
    rest, most = shared, NEAREST
    while True:
        pairs, left_out = _across(rest, labels, reps, percent, most, "parity" if rest is shared else "fine")
        labels = components(_verified(pairs, *args), labels)
        if not left_out.limit(1).count():
            break
        # A pair is left out by both of its sets, so all others have named theirs.
        rest, most = cut(rest.join(left_out, "rep", "left_semi")), most * FURTHER
    member = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    return sets.join(member, ["s1", "s2"], "left").select(
        F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("id")).alias("component_id"))
