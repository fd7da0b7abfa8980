"""Groups of near-duplicate documents by a chosen-path similarity join.

Documents are sets of word shingles; equal sets become one. In each of several independent trees,
a node draws one or two positions of the minwise signature (``1 / similarity`` of them on average)
and hands every document on to the child named by its token there; similar documents choose the
same path. Nodes small enough are compared exhaustively: a signature rules out far pairs, and what
is left is confirmed on the full sets. Pairs at the threshold meet in one tree with a probability
of about 0.6, so that ``TREES`` of them miss one in ten thousand, closer pairs hardly any.

A first tree joins most groups. The other trees then only compare documents not yet joined, and
drop nodes in which all are. So a group of thousands costs edges in proportion to its size, not to
its square. A node that does not fall apart down to ``DEPTH`` is first cut into runs by a hash, each
with the node's pivot, which joins groups of copies. Nodes that still hold several components after
all trees are then compared whole: every pair of their blocks in a task of its own, on full sets.
So ``DEPTH`` decides on the cost alone. That cost grows with the square of a family of documents
that share a template but are no copies of each other.

Null and empty texts, and such of blanks only, have empty sets and are linked with nothing. Copies
belong together whatever their ids; ids may be null or repeated (a group's id is its least id, null
only if all are). Sets are known by a 64-bit hash. An empty table gives an empty result. Only id
and text are read, so further columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfmark.llm.common import bytes_of, lower_words, map_batches, runs, stored
from shelfmark.llm.components import components, forest

POSITIONS = 96    # of the minwise signature, two bytes each
TREES = 10        # the first of them alone
NODE_ROWS = 64    # of a node that is compared exhaustively
FIRST_DEPTH = 3   # levels before nodes are counted: nearly all nodes above are too large
DEPTH = 5
BLOCK_ROWS = 1024         # documents in a block of a node that is compared whole
BLOCK_SHINGLES = 1 << 20  # about as many shingles in a block at most
_COLUMNS = 1024           # shingles that are counted at once
_LEAST_AGREEMENT = 4.0  # standard deviations below the expectation at the threshold

_MASK = (1 << 64) - 1
_DRAW = np.random.default_rng(20_260)
_FACTORS = _DRAW.integers(0, _MASK, POSITIONS, np.uint64, endpoint=True) | np.uint64(1)
_FIRST, _SECOND, _MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F),
                         np.uint64(0xD6E8FEB86659FD93))


def shingles(words: list[bytes], length: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``length`` are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(length, len(words))
    out = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        out = (out ^ h[k:len(words) - length + 1 + k]) * (_FIRST if k % 2 else _SECOND)
        out ^= out >> np.uint64(29)
    return np.unique(out * _MIX)


def set_key(found: np.ndarray) -> int:
    """The hash that a set is known by, as a signed long."""
    value = xxhash.xxh3_64_intdigest(found.tobytes())
    return value - (1 << 64) if value >> 63 else value


def signature(found: np.ndarray) -> bytes:
    """For every position the token of the set with the least hash, as two bytes."""
    least = np.full(POSITIONS, _MASK, np.uint64)
    for start in range(0, len(found), 2048):
        part = np.multiply.outer(_FACTORS, found[start:start + 2048])
        np.minimum(least, part.min(axis=1), out=least)
    return ((least * _MIX) >> np.uint64(48)).astype("<u2").tobytes()


def signatures(docs: DataFrame, length: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per document its id, the size of its set, the ``key`` of the set and its signature."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(lower_words(t), length) for t in bytes_of(batch, text_col)]
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(map(len, sets), pa.int64()),
             pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
             pa.array([signature(s) if len(s) else None for s in sets], pa.binary())],
            ["doc_id", "n_shingles", "key", "sig"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col],
                       f"doc_id {kind}, n_shingles bigint, key bigint, sig binary", work)


def _step(rows: DataFrame, similarity: float) -> DataFrame:
    """Every row handed on along the paths its node draws."""
    def drawn(number: int) -> Column:
        return F.pmod(F.xxhash64("path", F.lit(number)), F.lit(POSITIONS))
    more = (1 / similarity - 1) * 1_000_000
    second = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(1_000_000)) < more
    places = F.when(second, F.array_distinct(F.array(drawn(1), drawn(2)))).otherwise(
        F.array(drawn(1)))
    token = F.expr("substring(sig, cast(2 * _at as int) + 1, 2)")
    return (rows.withColumn("_at", F.explode(places))
            .withColumn("path", F.xxhash64("path", "_at", token)).drop("_at"))


def leaves(sets: DataFrame, trees: range, similarity: float, node_rows: int = NODE_ROWS,
           depth: int = DEPTH) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``sets`` (key, comp, n_shingles, sig) in the nodes that are compared: ``leaf`` names
    the node. Nodes of one component are left out. Then ``path`` and ``key`` of the nodes that
    were cut into runs, if there are any.

    Only paths and keys are shuffled while nodes are counted; signatures join again those few rows
    whose nodes go on or are compared.
    """
    rows = sets.select("key", "comp", "sig").withColumn("path", F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.lit("tree")) for t in trees])))
    for _ in range(FIRST_DEPTH):
        rows = _step(rows, similarity)
    done = large = None
    for level in range(FIRST_DEPTH, depth + 1):
        rows = rows.select("path", "key", "comp")
        nodes = (rows.groupBy("path")
                 .agg(F.count("*").alias("_n"), F.min("key").alias("_pivot"),
                      F.min("comp").alias("_low"), F.max("comp").alias("_high"))
                 .where("_low <> _high").drop("_low", "_high"))
        rows = stored(rows.join(nodes, "path"), f"tree-level-{level}")
        part = rows.where(F.col("_n") <= node_rows).select(F.col("path").alias("leaf"), "key")
        done = part if done is None else done.unionAll(part)
        rows = rows.where(F.col("_n") > node_rows)
        if not rows.limit(1).count():
            break
        if level < depth:
            rows = _step(rows.drop("comp").join(sets.select("key", "comp", "sig"), "key"),
                         similarity)
    else:
        # What does not fall apart goes to runs, the pivot to each, and is compared whole later.
        large = rows.select("path", "key")
        parts = F.ceil(2 * F.col("_n") / node_rows).cast("bigint")
        places = F.when(F.col("key") == F.col("_pivot"),
                        F.sequence(F.lit(0).cast("bigint"), parts - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("key", "path"), parts)))
        done = done.unionAll(rows.withColumn("_run", F.explode(places)).select(
            F.xxhash64("path", "_run").alias("leaf"), "key"))
    own = F.lit(None).cast("array<bigint>").alias("leaves")
    if len(trees) > 1:
        # A few leaves per tree, by which two documents that meet in several know the one.
        sets = sets.join(done.groupBy("key").agg(F.collect_set("leaf").alias("leaves")), "key")
        own = F.col("leaves")
    near = done.join(sets, "key").select("leaf", "key", "comp", "n_shingles", "doc_id", "sig", own)
    return near, large


def _likely(similarity: float):
    """Per leaf the documents that may have a partner, with the keys of those after them.

    A pair that meets in several leaves belongs to the lowest of them, which each leaf can tell by
    itself from the lists of leaves of both."""
    expected = similarity * POSITIONS
    least = expected - _LEAST_AGREEMENT * np.sqrt(expected * (1 - similarity))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "leaf"):
            n = group.num_rows
            if n < 2:
                continue
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u2").reshape(n, -1)
            size = group.column("n_shingles").to_numpy()
            comp, key = group.column("comp").to_numpy(), group.column("key").to_numpy()
            low, high = np.minimum.outer(size, size), np.maximum.outer(size, size)
            good = (low >= similarity * high - 1e-9 * high) & (comp[:, None] != comp[None, :])
            good[np.tril_indices(n)] = False
            first, second = np.nonzero(good)
            for start in range(0, len(first), 65_536):
                a, b = first[start:start + 65_536], second[start:start + 65_536]
                far = (sig[a] == sig[b]).sum(axis=1) < least
                good[a[far], b[far]] = False
            if group.column("leaves").null_count == 0:
                leaf = group.column("leaf")[0].as_py()
                own = [frozenset(x) for x in group.column("leaves").to_pylist()]
                a, b = np.nonzero(good)
                other = [min(own[x] & own[y]) != leaf
                         for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                good[a[other], b[other]] = False
            involved = np.flatnonzero(good.any(axis=0) | good.any(axis=1))
            if len(involved):
                yield pa.RecordBatch.from_arrays(
                    [group.column(c).combine_chunks().take(pa.array(involved))
                     for c in ("leaf", "key", "comp", "doc_id")]
                    + [pa.array([key[good[i]].tolist() for i in involved], pa.list_(pa.int64()))],
                    ["leaf", "key", "comp", "rep", "partners"])
    return work


def _linked(similarity: float, length: int):
    """Per leaf enough links, confirmed on full sets, to join all that belong together."""
    percent = round(similarity * 100)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "leaf"):
            sets: dict[int, np.ndarray] = {}
            keys = group.column("key").to_pylist()
            for key, text in zip(keys, bytes_of(group, "_text"), strict=True):
                found = shingles(lower_words(text), length)
                # Another text of the same id has another key.
                if set_key(found) == key:
                    sets[key] = found
            parent = dict(zip(keys, group.column("comp").to_pylist(), strict=True))
            top = {c: c for c in parent.values()}

            def root(key: int, parent=parent, top=top) -> int:
                c = parent[key]
                while top[c] != c:
                    top[c] = top[top[c]]
                    c = top[c]
                return c
            links = []
            pairs = {(k, p) for k, ps in zip(keys, group.column("partners").to_pylist(),
                                             strict=True) for p in ps}
            for a, b in sorted(pairs):
                if a not in sets or b not in sets or root(a) == root(b):
                    continue
                x, y = sets[a], sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    top[root(a)] = root(b)
                    links.append((a, b))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[i] for k in links], pa.int64()) for i in (0, 1)], ["a", "b"])
    return work


def shared(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` has in common with each of ``other``."""
    both = np.zeros((len(one), len(other)), np.float32)
    if not one or not other:
        return both
    first, second = np.concatenate(one), np.concatenate(other)
    known = np.intersect1d(first, second)
    row = np.repeat(np.arange(len(one)), [len(s) for s in one])
    column = np.repeat(np.arange(len(other)), [len(s) for s in other])

    def places(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(known, values)
        at[at == len(known)] = 0
        held = np.flatnonzero(known[at] == values) if len(known) else np.zeros(0, np.int64)
        held = held[np.argsort(at[held], kind="stable")]
        return at[held], owner[held]
    (at_a, row), (at_b, column) = places(first, row), places(second, column)
    for start in range(0, len(known), _COLUMNS):
        width = min(_COLUMNS, len(known) - start)
        parts = []
        for at, owner, n in ((at_a, row, len(one)), (at_b, column, len(other))):
            low, high = np.searchsorted(at, [start, start + width])
            part = np.zeros((n, width), np.float32)
            part[owner[low:high], at[low:high] - start] = 1
            parts.append(part)
        both += parts[0] @ parts[1].T
    return both


def _whole(similarity: float):
    """Per pair of blocks enough links between components to join all that belong together."""
    percent = round(similarity * 100)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "leaf"):
            comp, side = (group.column(c).to_numpy() for c in ("comp", "side"))
            if (comp == comp[0]).all():
                continue
            found = [np.frombuffer(s, np.uint64) for s in group.column("found").to_pylist()]
            size = np.array([len(s) for s in found], np.float64)
            # One side alone is a block against itself.
            sides = [np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())]
            met = set()
            for start in range(0, len(sides[0]), 256):
                a, b = sides[0][start:start + 256], sides[1]
                both = shared([found[i] for i in a], [found[i] for i in b]).astype(np.float64)
                close = 100 * both >= percent * (size[a][:, None] + size[b][None, :] - both)
                close &= comp[a][:, None] != comp[b][None, :]
                x, y = np.nonzero(close)
                if len(x):
                    met.update(map(tuple, np.unique(
                        np.stack([comp[a[x]], comp[b[y]]], axis=1), axis=0).tolist()))
            pairs = forest([x for x, _ in met], [y for _, y in met])
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])
    return work


def whole_links(docs: DataFrame, sets: DataFrame, large: DataFrame, similarity: float, length: int,
                id_col: str, text_col: str) -> DataFrame | None:
    """Confirmed links (a, b) between all documents of the nodes ``large`` (path, key) that hold
    several components, or None if no node does."""
    rows = large.join(sets.select("key", "comp", "n_shingles"), "key")
    nodes = (rows.groupBy("path").agg(
        F.count("*").alias("_n"), F.sum("n_shingles").alias("_all"),
        F.min("comp").alias("_low"), F.max("comp").alias("_high"))
        .where("_low <> _high")
        .select("path", F.ceil(F.greatest(F.col("_n") / BLOCK_ROWS, F.col("_all") / BLOCK_SHINGLES))
                .cast("bigint").alias("_blocks")))
    rows = stored(rows.join(nodes, "path").select("path", "key", "comp", "_blocks"), "large-nodes")
    if not rows.limit(1).count():
        return None

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(lower_words(t), length) for t in bytes_of(batch, "_text")]
        # Another text of the same id has another key.
        good = [set_key(s) == k for s, k in zip(found, batch.column("key").to_pylist(),
                                                strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array([s.tobytes() if g else None
                                            for s, g in zip(found, good, strict=True)],
                                           pa.binary())], ["key", "found"])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    reps = rows.select("key").distinct().join(
        sets.select("key", F.col("doc_id").alias("rep")), "key")
    found = map_batches(reps.hint("merge").join(texts, reps.rep.eqNullSafe(texts["_id"])),
                        ["key", "_text"], "key bigint, found binary", sets_of)
    found = stored(found.where("found is not null").groupBy("key").agg(
        F.first("found").alias("found")), "large-sets")
    own = F.pmod(F.xxhash64("key", F.lit("block")), F.col("_blocks"))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    dealt = (rows.withColumn("_own", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                        F.col("_blocks") - 1)))
             .select(F.xxhash64("path", low, high).alias("leaf"), "key", "comp",
                     F.col("_own").alias("side")))
    return (dealt.join(found, "key").repartition("leaf").sortWithinPartitions("leaf")
            .mapInArrow(_whole(similarity), "a bigint, b bigint"))


def links(docs: DataFrame, sets: DataFrame, trees: range, similarity: float, length: int,
          id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Confirmed links (a, b) between keys, found in some trees, and nodes as of ``leaves`` of
    which not all pairs were compared."""
    kind = docs.schema[id_col].dataType.simpleString()
    near, large = leaves(sets, trees, similarity, NODE_ROWS, DEPTH)
    likely = (near.repartition("leaf").sortWithinPartitions("leaf")
              .mapInArrow(_likely(similarity), f"leaf bigint, key bigint, comp bigint, "
                                               f"rep {kind}, partners array<bigint>"))
    likely = stored(likely, "likely")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # Shuffled at every size: the documents involved grow with the input.
    full = (likely.hint("merge").join(texts, likely.rep.eqNullSafe(texts["_id"]))
            .select("leaf", "key", "comp", "partners", "_text"))
    return (full.repartition("leaf").sortWithinPartitions("leaf")
            .mapInArrow(_linked(similarity, length), "a bigint, b bigint")), large


def groups(docs: DataFrame, similarity: float = 0.8, length: int = 5, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_shingles`` and ``component_id``, the least id of the documents
    that links lead to, itself included; ``kept`` tells whether it has that id itself."""
    return _grouped(docs, similarity, length, id_col, text_col).drop("key", "one")


def _grouped(docs: DataFrame, similarity: float, length: int, id_col: str,
             text_col: str) -> DataFrame:
    """``groups`` with the ``key`` of each document's set; ``one`` tells whether the document
    stands for its component: it has the least id and the one set chosen of those with that id.
    Without words every document does."""
    signed = stored(signatures(docs, length, id_col, text_col), "signatures")
    sets = stored(signed.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"),
        F.max("sig").alias("sig")), "sets")
    first, large = links(docs, sets.withColumn("comp", F.col("key")), range(1), similarity, length,
                         id_col, text_col)
    found = stored(first, "links")
    labels = components(found)

    def with_component(labels: DataFrame) -> DataFrame:
        return sets.join(labels, sets.key == labels.node, "left").select(
            "key", "doc_id", "n_shingles", "sig", F.coalesce("root", "key").alias("comp"))
    more, others = links(docs, with_component(labels), range(1, TREES), similarity, length, id_col,
                         text_col)
    found = found.unionAll(stored(more, "links"))
    labels = components(found)
    large = others if large is None else large if others is None else large.unionAll(others)
    if large is not None:
        rest = whole_links(docs, with_component(labels), large, similarity, length, id_col,
                           text_col)
        if rest is not None:
            labels = components(found.unionAll(stored(rest, "links")))
    members = with_component(labels).select("key", "comp", "doc_id")
    # Null comes last: it is the id of a component only if no document has one.
    least = members.groupBy("comp").agg(F.min(F.struct(
        F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("least"))
    by_key = members.join(least, "comp").select(
        "key", F.col("least.doc_id").alias("component_id"),
        (F.col("key") == F.col("least.key")).alias("_chosen"))
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    with_words = signed.where("key is not null").join(by_key, "key").select(
        "doc_id", "n_shingles", "component_id", same.alias("kept"), "key",
        (F.col("_chosen") & same).alias("one"))
    without = signed.where("key is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
        "key", F.lit(True).alias("one"))
    return with_words.unionAll(without)


def one_of_each(docs: DataFrame, similarity: float = 0.8, length: int = 5,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one of the least id, with all its columns.

    Documents of null or repeated ids are told apart by their sets; of rows that share the id and
    the set one stays. Documents without words belong to no group and all stay.
    """
    found = stored(_grouped(docs, similarity, length, id_col, text_col).select(
        "doc_id", "key", "one"), "grouped")
    # In one struct the columns of a row cannot clash with those of the joins.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = (found.where("doc_id is not null").groupBy(F.col("doc_id").alias("kept"))
            .agg(F.count("*").alias("n"), F.max("one").alias("one")).where("one"))
    met = whole.join(rows.hint("merge"), F.col("id") == F.col("kept"))
    once = met.where("n = 1").select("row")
    again = met.where("n > 1").select("row", "id", "text").unionAll(whole.where("id is null"))

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(lower_words(t), length) for t in bytes_of(batch, "text")]
        keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), keys], ["row", "id", "set_key"])
    again = map_batches(again, again.columns, StructType(
        [whole.schema["row"], whole.schema["id"], StructField("set_key", LongType())]), keyed)
    chosen = found.where("one and key is not null").select(
        F.col("key").alias("chosen"), F.col("doc_id").alias("kept")).distinct()
    told = again.join(chosen.hint("merge"), (F.col("set_key") == F.col("chosen"))
                      & F.col("id").eqNullSafe(F.col("kept"))).select(
        "row", "set_key").dropDuplicates(["set_key"]).select("row")
    rest = again.where("set_key is null").select("row")
    return once.unionAll(told).unionAll(rest).select("row.*")


ORACLE = r"""
with recursive words as (select doc_id, list_filter(string_split_regex(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
shingles as (select distinct doc_id, ws[i] || ' ' || ws[i + 1] as s
  from (select doc_id, ws, unnest(range(1, len(ws))) as i from words)
  union all select doc_id, ws[1] from words where len(ws) = 1),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as both_have
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * both_have >= 80 * (p.n + q.n - both_have)),
reach as (select doc_id as x, doc_id as y from documents
  union select r.x, l.y from reach r join links l on l.x = r.y),
least as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id,
  d.doc_id = component_id as kept
from documents d join least on least.x = d.doc_id left join sizes on sizes.doc_id = d.doc_id"""
