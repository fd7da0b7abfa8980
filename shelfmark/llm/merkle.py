"""A Merkle manifest of a table, with a proof of every row by octopus multiproofs.

Each row is a leaf, the hash of its fields. The leaves of a group, in the order of their ids, make
a tree whose nodes stand for up to ``FANOUT`` nodes below; the subroots of all groups, in the
order of the groups, make the tree above them. A run may be shorter at the end of a level, down to
one node, which is hashed alone.

Leaves are numbered by a range sort and dealt into parts of ``FANOUT ** LEVELS`` neighbours, so
that a group of any size is spread over many tasks. Only the tops of parts are written while the
tree is built; the levels above shrink by that factor a round. For the proofs every part then
works out the smallest set of nodes that it lacks to reach the root from its own leaves, fetches
these once by a join, derives all nodes in between, and expands the proof of each leaf from them.

A proof lists, level by level up to the root, what stands left and right of the node in its run;
whoever has the leaf folds it into the root (``folded``) without any other knowledge.

Null ids come first in their group, null groups first of all; rows of one id follow their hashes,
so repeated rows have equal leaves and proofs of their own. A null field is hashed as ``-``, which
no value gives. Texts of any length are hashed in the JVM. An empty table gives an empty result.
Only the columns named are read; further ones do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import runs, stored

FANOUT = 3
LEVELS = 7  # of the subtree over a part: 2,187 leaves
TOP = -1    # the tree of the subroots; the others are numbered from 0
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree bigint, level int, idx bigint, n bigint, hash string"


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of some fields: each as its length in bytes and its text, ``-`` where null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in texts]), 256)


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
           group_col: str = "source", now: dict[str, Column] | None = None) -> DataFrame:
    """Per row ``doc_id``, ``source``, its ``leaf``, and the leaf ``seen`` when the fields of
    ``now`` have these values instead."""
    now = now or {}
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(group_col).alias("source"),
        leaf([F.col(f) for f in fields]).alias("leaf"),
        leaf([now.get(f, F.col(f)) for f in fields]).alias("seen"))


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows with their place ``at`` in an order, from 0, by a range sort.

    Each task numbers its own range; what is counted in one place is one number per task.
    """
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_row", F.monotonically_increasing_id()), name)
    task = F.shiftright("_row", 33)
    before = F.sum("_n").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = (rows.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
              .select("_task", F.coalesce(before, F.lit(0)).alias("_start")))
    # As many rows as there were tasks.
    return (rows.join(F.broadcast(starts), task == F.col("_task"))
            .withColumn("at", F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1))
            .drop("_row", "_task", "_start"))


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def missing(known: set[int], n: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, index) that lead from some leaves of a tree of ``n`` to its root."""
    found = []
    for level in range(height(n)):
        above = {i // FANOUT for i in known}
        found += [(level, i) for p in sorted(above)
                  for i in range(p * FANOUT, min((p + 1) * FANOUT, n)) if i not in known]
        known, n = above, -(-n // FANOUT)
    return found


def derive(levels: list[dict[int, str]], n: int) -> list[dict[int, str]]:
    """All nodes that follow from those known at each level, in place."""
    for level in range(height(n)):
        here = levels[level]
        for p in {i // FANOUT for i in here}:
            levels[level + 1][p] = _hash(*[here[i] for i in range(
                p * FANOUT, min((p + 1) * FANOUT, n))])
        n = -(-n // FANOUT)
    return levels


def _columns(group: pa.Table, *names: str) -> list[list]:
    return [group.column(n).to_pylist() for n in names]


def _rise(levels: int, only_top: bool):
    """The nodes above runs of neighbours, up to so many levels or the root.

    A part is a run, or several by a chance of the hash, in order of tree and place."""
    size = FANOUT ** levels

    def above(run: pa.Table) -> list[tuple]:
        tree, level, low, n = (run.column(c)[0].as_py() for c in ("tree", "level", "idx", "n"))
        hashes = run.column("hash").to_pylist()
        top = min(height(n), level + levels)
        out = [(tree, level, low, n, hashes[0])] if only_top and top == level else []
        while level < top:
            hashes = [_hash(*hashes[k:k + FANOUT]) for k in range(0, len(hashes), FANOUT)]
            level, low = level + 1, low // FANOUT
            if level == top or not only_top:
                out += [(tree, level, low + k, n, h) for k, h in enumerate(hashes)]
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in runs(batches, "part"):
            trees, places = (group.column(c).to_numpy() for c in ("tree", "idx"))
            block = places // size
            cuts = np.flatnonzero((trees[1:] != trees[:-1]) | (block[1:] != block[:-1])) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(trees)], strict=True):
                out += above(group.slice(start, end - start))
            if len(out) > 4096:
                yield _nodes(out)
                out = []
        if out:
            yield _nodes(out)
    return work


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        ["tree", "level", "idx", "n", "hash"])


def _risen(nodes: DataFrame, levels: int, only_top: bool) -> DataFrame:
    """Nodes above those given, which are the whole of a level of each of their trees."""
    size = FANOUT ** levels
    part = F.xxhash64("tree", F.floor(F.col("idx") / size))
    return stored(nodes.withColumn("part", part).repartition("part")
                  .sortWithinPartitions("part", "tree", "idx")
                  .mapInArrow(_rise(levels, only_top), _NODE), "nodes")


def upper_nodes(first: DataFrame, level: int, levels: int) -> DataFrame:
    """All nodes of the trees from ``level`` up, given those of that level (and the roots of
    trees that are lower)."""
    found, here = first, first
    tallest = first.agg(F.max("n")).first()[0] or 0
    while level < height(tallest):
        above = _risen(here.where(F.col("level") == level), levels, False)
        found = found.unionAll(above)
        level += levels
        here = above
    return found


def manifest(rows: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame, int]:
    """The leaves with their places (``tree``, ``idx`` in it, ``n`` leaves of it, ``part``), the
    nodes from the tops of parts up to the root, and the number of groups."""
    size = FANOUT ** levels
    ordered = numbered(rows, ["source", "doc_id", "leaf", "seen"], "leaves")
    groups = numbered(ordered.groupBy("source").agg(
        F.min("at").alias("first"), F.count("*").alias("n")), ["first"], "groups")
    groups = groups.select(F.col("source").alias("_source"), F.col("at").alias("tree"), "first",
                           "n")
    idx = F.col("at") - F.col("first")
    placed = ordered.join(groups, ordered.source.eqNullSafe(F.col("_source"))).select(
        "doc_id", "leaf", "seen", "tree", idx.alias("idx"), "n",
        # The place of the part's first leaf among all leaves: a name that no other part has.
        (F.col("first") + F.floor(idx / size) * size).alias("part"))
    tops = stored(placed.select("part", "tree", F.lit(0).alias("level"), "idx", "n",
                                F.col("leaf").alias("hash"))
                  .repartition("part").sortWithinPartitions("part", "idx")
                  .mapInArrow(_rise(levels, True), _NODE), "nodes")
    nodes = upper_nodes(tops, levels, levels)
    count = groups.count()
    heights = F.expr(f"aggregate(sequence(0, 64), struct(n as w, 0 as h), (a, x) -> if(a.w > 1, "
                     f"struct(ceil(a.w / {FANOUT}) as w, a.h + 1 as h), a)).h")
    subroots = stored(nodes.where(F.col("level") == heights).select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"),
        F.col("tree").alias("idx"), F.lit(count).cast("bigint").alias("n"), "hash"), "subroots")
    return placed, nodes.unionAll(upper_nodes(subroots, 0, levels)), count


def _requests(count: int):
    """Per part the nodes it lacks, those of the tree above it included."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "part"):
            part, tree, n = (group.column(c)[0].as_py() for c in ("part", "tree", "n"))
            wanted = [(tree, *c) for c in missing(set(group.column("idx").to_pylist()), n)]
            wanted += [(TOP, *c) for c in missing({tree}, count)]
            if wanted:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(wanted), pa.int64())]
                    + [pa.array(c, k) for c, k in zip(
                        zip(*wanted, strict=True), (pa.int64(), pa.int32(), pa.int64()),
                        strict=True)], ["part", "_tree", "_level", "_idx"])
    return work


def _expanded(id_type: pa.DataType, count: int):
    """Per part the proof of every leaf, from its leaves and the nodes it has fetched."""
    def siblings(here: dict[int, str], i: int, n: int) -> tuple[str, str]:
        low, high = i // FANOUT * FANOUT, min((i // FANOUT + 1) * FANOUT, n)
        return ("".join(here[k] for k in range(low, i)),
                "".join(here[k] for k in range(i + 1, high)))

    def steps(levels: list[dict[int, str]], i: int, n: int, seen: dict) -> list[tuple[str, str]]:
        out = []
        for level in range(len(levels) - 1):
            if (level, i) not in seen:
                seen[level, i] = siblings(levels[level], i, n)
            out.append(seen[level, i])
            i, n = i // FANOUT, -(-n // FANOUT)
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "part"):
            fetched, own = [], []
            for row in zip(*_columns(group, "tree", "level", "idx", "hash", "n"), strict=True):
                (own if row[4] is not None else fetched).append(row)
            tree, n = own[0][0], own[0][4]
            below: list[dict[int, str]] = [{} for _ in range(height(n) + 1)]
            above: list[dict[int, str]] = [{} for _ in range(height(count) + 1)]
            below[0] = {row[2]: row[3] for row in own}
            for t, level, i, h, _ in fetched:
                (above if t == TOP else below)[level][i] = h
            subroot = derive(below, n)[-1][0]
            above[0][tree] = subroot
            root = derive(above, count)[-1][0]
            cached: dict = {}
            last = steps(above, tree, count, {})
            proofs = [steps(below, row[2], n, cached) + last for row in own]
            flat = [s for p in proofs for s in p]
            offsets = [0]
            for p in proofs:
                offsets.append(offsets[-1] + len(p))
            is_own = group.column("n").is_valid()
            mine = group.filter(is_own).combine_chunks()
            proof = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)],
                    ["left", "right"]))
            yield pa.RecordBatch.from_arrays(
                [mine.column("doc_id").combine_chunks().cast(id_type),
                 mine.column("hash").combine_chunks(), mine.column("seen").combine_chunks(),
                 pa.array([subroot] * len(own), pa.string()),
                 pa.array([root] * len(own), pa.string()), proof],
                ["doc_id", "leaf", "seen", "subroot", "root", "proof"])
    return work


def proofs(rows: DataFrame, wanted: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row of ``leaves``: ``doc_id``, ``leaf``, ``seen``, ``subroot``, ``root`` and ``proof``,
    the texts ``left`` and ``right`` of the node at every level.

    ``wanted`` (a column ``doc_id``) limits the proofs, not the tree, to some rows. Parts are known
    by the place of their first leaf, nodes by their coordinates; no hash of them can collide.
    """
    placed, nodes, count = manifest(rows, levels)
    whole = placed
    if wanted is not None:
        wanted = wanted.select(F.col("doc_id").alias("_wanted")).distinct()
        placed = placed.join(wanted, placed.doc_id.eqNullSafe(F.col("_wanted")), "left_semi")
        # The leaves of a part that are not wanted can be missing, too.
        parts = placed.select("part").distinct()
        nodes = nodes.unionAll(_inside(whole.join(parts, "part", "left_semi"), levels))
    nodes = nodes.dropDuplicates(["tree", "level", "idx"]) if wanted is not None else nodes
    asked = (placed.select("part", "tree", "idx", "n").repartition("part")
             .sortWithinPartitions("part").mapInArrow(
        _requests(count), "part bigint, _tree bigint, _level int, _idx bigint"))
    fetched = asked.join(nodes, (F.col("_tree") == F.col("tree")) & (F.col("_level") == F.col("level"))
                         & (F.col("_idx") == F.col("idx")))
    kind = rows.schema["doc_id"].dataType
    none = F.lit(None)
    both = placed.select("part", "tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("hash"),
                         "n", "doc_id", "seen").unionAll(fetched.select(
        "part", "tree", "level", "idx", "hash", none.cast("bigint"), none.cast(kind),
        none.cast("string")))
    return (both.repartition("part").sortWithinPartitions("part").mapInArrow(
        _expanded(to_arrow_type(kind), count),
        f"doc_id {kind.simpleString()}, leaf string, seen string, subroot string, root string, "
        f"proof array<struct<left:string,right:string>>"))


def _inside(placed: DataFrame, levels: int) -> DataFrame:
    """All nodes of some whole parts, leaves included."""
    leaf_nodes = placed.select("part", "tree", F.lit(0).alias("level"), "idx", "n",
                               F.col("leaf").alias("hash"))
    above = (leaf_nodes.repartition("part").sortWithinPartitions("part", "idx")
             .mapInArrow(_rise(levels, False), _NODE))
    return leaf_nodes.drop("part").unionAll(above)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, step: F.sha2(
        F.concat(step["left"], node, step["right"]), 256))


def report(proved: DataFrame) -> DataFrame:
    """The digest of every proof, and whether the leaf as seen still leads to the root."""
    siblings = F.array_join(F.transform(
        "proof", lambda s: F.concat(s["left"], s["right"])), "")
    out = proved.withColumn("folded_root", folded(F.col("seen"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root",
                      F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def without_line_ends(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text as a tamperer leaves it: line ends are gone where the id's checksum is even."""
    even = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    return F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(
        F.col(text_col))


ORACLE = r"""
with recursive docs as (
  select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as idx,
    sha256(concat(f_id, f_source, f_lang, f_chars, coalesce(strlen(text) || ':' || text, '-'))) as leaf,
    sha256(concat(f_id, f_source, f_lang, f_chars, coalesce(strlen(now) || ':' || now, '-'))) as seen
  from (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') as f_id,
      coalesce(strlen(source) || ':' || source, '-') as f_source,
      coalesce(strlen(lang) || ':' || lang, '-') as f_lang,
      coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as f_chars,
      case when list_reduce(list_prepend(4294967295::bigint,
          list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substring(doc_id::varchar, i, 1))::bigint)),
          lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) % 2 = 1
        then replace(text, chr(10), '') else text end as now
    from documents) d),
groups as (select source, row_number() over (order by source nulls first) - 1 as tree, count(*) as n
  from docs group by source),
nodes as (
  select tree, 0 as level, idx, leaf as hash, n from docs d join groups g on d.source is not distinct from g.source
  union all
  select tree, level + 1, idx // 3, sha256(string_agg(hash, '' order by idx)), ceil(n / 3)::bigint
  from nodes where n > 1 group by tree, level, idx // 3, n),
tops as (
  select 0 as level, tree as idx, hash, (select count(*) from groups) as n from nodes where n = 1
  union all
  select level + 1, idx // 3, sha256(string_agg(hash, '' order by idx)), ceil(n / 3)::bigint
  from tops where n > 1 group by level, idx // 3, n),
every as (select tree, level, idx, hash, n from nodes
  union all select -1, level, idx, hash, n from tops),
steps as (select tree, level, idx,
    coalesce(lag(hash, 2) over w, '') || coalesce(lag(hash, 1) over w, '') as l,
    coalesce(lead(hash, 1) over w, '') || coalesce(lead(hash, 2) over w, '') as r
  from every where n > 1 window w as (partition by tree, level, idx // 3 order by idx)),
heights as (select tree, max(level) as h from nodes group by tree),
folds as (
  select doc_id, g.tree, g.tree as at_tree, 0 as level, d.idx, '' as proof, seen as cur, leaf
  from docs d join groups g on d.source is not distinct from g.source
  union all
  select f.doc_id, f.tree,
    case when s.tree is null then -1 else f.at_tree end,
    case when s.tree is null then 0 else f.level + 1 end,
    case when s.tree is null then f.tree else f.idx // 3 end,
    case when s.tree is null then f.proof else f.proof || s.l || s.r end,
    case when s.tree is null then f.cur else sha256(s.l || f.cur || s.r) end, f.leaf
  from folds f left join steps s on s.tree = f.at_tree and s.level = f.level and s.idx = f.idx
  where s.tree is not null or f.at_tree >= 0),
ended as (select f.* from folds f
  where at_tree = -1 and level = (select max(level) from tops))
select e.doc_id, e.leaf, n.hash as subroot, t.hash as root, sha256(e.proof) as proof_sha256,
  e.cur as folded_root, e.cur = t.hash as verified
from ended e join nodes n on n.tree = e.tree and n.n = 1 join tops t on t.n = 1"""
