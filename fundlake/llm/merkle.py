"""Merkle manifest of a dataset, with incremental witnesses.

Rows are leaves. The leaves of a group (here: a language), in order, are appended one by one to a forest of open subtrees:
a new leaf is a subtree of its own, and two neighbouring subtrees of one height become one. An open subtree carries the
partial witnesses of its leaves; when its sibling is complete, every witness of the left one is extended by the root of
the right one and the other way round. Appending is aligned: a task takes a block of ``BLOCK`` leaves that begins at a
multiple of ``BLOCK``, so a block is a subtree of the whole tree whatever the other blocks hold. The block roots are then
appended in the same way, in blocks of blocks, until one root is left, and what the blocks' own witnesses gain extends the
witnesses of their leaves. The roots of the groups are the leaves of one more tree.

A block is the unit of work: at most ``BLOCK`` digests are in memory, a group of any size is many blocks, and only block
roots climb. Everything after the witnesses (proofs, folding a claimed leaf to the root) is a column expression.

Defined results: nulls in any column are hashed as ``-``; a null group comes first; rows that repeat an id, or have none,
are ordered by their leaf, nulls first; equal rows are leaves of their own; no rows give no leaves; columns that are not
named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import prepare, read, stage
from fundlake.llm.ranking import numbered

BLOCK = 1024
#: A step of a witness is what stands left and right of the node before hashing; a node without a sibling has neither.
STEPS = "array<struct<left:string,right:string>>"
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*columns: str | Column) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, a colon and the value; ``-`` for null."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(start: Column, witness: Column) -> Column:
    """Root that follows from a leaf and its witness."""
    return F.aggregate(witness, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(witness: Column) -> Column:
    """Digest of the siblings of a witness, in the order from leaf to root."""
    return digest(F.array_join(F.transform(witness, lambda step: F.concat(step["left"], step["right"])), ""))


class _Open:
    """An open subtree: its height, root, and the partial witnesses of its leaves in order."""

    __slots__ = ("height", "root", "witnesses")

    def __init__(self, height: int, root: str, witnesses: list[list[tuple[str, str]]]):
        self.height, self.root, self.witnesses = height, root, witnesses

    def join(self, right: _Open) -> _Open:
        """This subtree and its complete sibling to the right as one."""
        for witness in self.witnesses:
            witness.append(("", right.root))
        for witness in right.witnesses:
            witness.append((self.root, ""))
        root = sha256((self.root + right.root).encode()).hexdigest()
        return _Open(self.height + 1, root, self.witnesses + right.witnesses)

    def rise(self) -> _Open:
        """This subtree one level up, for want of a sibling."""
        for witness in self.witnesses:
            witness.append(("", ""))
        return _Open(self.height + 1, sha256(self.root.encode()).hexdigest(), self.witnesses)


class Frontier:
    """The open subtrees after appending some leaves, from the highest to the lowest."""

    def __init__(self) -> None:
        self.open: list[_Open] = []

    def append(self, node: str) -> None:
        self.open.append(_Open(0, node, [[]]))
        while len(self.open) > 1 and self.open[-1].height == self.open[-2].height:
            right = self.open.pop()
            self.open[-1] = self.open[-1].join(right)

    def close(self, height: int | None = None) -> tuple[str, list[list[tuple[str, str]]]]:
        """Root and witnesses once nothing follows; ``height`` is that of a subtree with siblings, None that of the whole."""
        top = self.open.pop()
        while self.open:
            while top.height < self.open[-1].height:
                top = top.rise()
            top = self.open.pop().join(top)
        while height is not None and top.height < height:
            top = top.rise()
        return top.root, top.witnesses


def _append_blocks(nodes: DataFrame, block: int) -> DataFrame:
    """``nodes`` (tree, place, size, node, further columns) with ``witness`` within its block and the block's ``root``."""
    names, height = nodes.columns, block.bit_length() - 1

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frontier, held, here = Frontier(), [], None

        def closed() -> pa.RecordBatch:
            root, witnesses = frontier.close(height if held[0]["size"] > block else None)
            steps = [[{"left": a, "right": b} for a, b in witness] for witness in witnesses]
            return pa.RecordBatch.from_pylist(
                [row | {"witness": w, "root": root} for row, w in zip(held, steps, strict=True)], schema=schema
            )

        for batch in batches:
            schema = pa.schema([*batch.schema, pa.field("witness", steps_type), pa.field("root", pa.string())])
            for row in batch.to_pylist():
                at = (row["tree"], row["place"] // block)
                if held and at != here:
                    yield closed()
                    frontier, held = Frontier(), []
                here = at
                held.append(row)
                frontier.append(row["node"])
        if held:
            yield closed()

    steps_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in nodes.dtypes)
    dealt = nodes.withColumn("_block", F.expr(f"place div {block}L")).repartition("tree", "_block")
    return dealt.sortWithinPartitions("tree", "place").select(*names).mapInArrow(compute, f"{kinds}, witness {STEPS}, root string")


def witnesses(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``nodes`` with ``witness``, the steps up to the ``root`` of their tree.

    ``nodes`` has tree (not null), place and size as ``ranking.numbered`` gives them, node (a digest in hexadecimal), and
    columns that are passed on. ``block`` is a power of two from 2 on.
    """
    if block < 2 or block & (block - 1):
        raise ValueError(f"block has to be a power of two from 2 on, not {block}")
    done = stage(_append_blocks(nodes, block), "blocks")
    longest = done.agg(F.max("size")).first()[0] or 0
    if longest <= block:
        return done
    # Block roots are further appends, one level of blocks up; lone blocks are whole trees and climb no more.
    tops = done.where(f"size > {block} and place % {block} = 0").select(
        "tree", F.expr(f"place div {block}L").alias("place"), F.expr(f"(size + {block - 1}L) div {block}L").alias("size"), F.col("root").alias("node")
    )
    above = witnesses(tops, block).select("tree", F.col("place").alias("_block"), F.col("witness").alias("_above"), F.col("root").alias("_top"))
    joined = done.withColumn("_block", F.expr(f"place div {block}L")).join(above, ["tree", "_block"], "left")
    return joined.select(
        *nodes.columns, F.concat("witness", F.coalesce("_above", F.array().cast(STEPS))).alias("witness"), F.coalesce("_top", "root").alias("root")
    )


def manifest(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """``leaves`` (group, doc_id, leaf, further columns) with their group's ``subroot``, the ``root`` of all and the
    ``witness`` that leads from the leaf to it."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))  # not null, in the order of the groups
    nodes = numbered(leaves.withColumn("tree", tree).withColumnRenamed("leaf", "node"), "tree", "doc_id", "node")
    below = stage(witnesses(nodes, block), "group_trees")
    groups = below.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    above = witnesses(numbered(groups, "tree", "name"), block)
    above = above.select(F.col("name").alias("tree"), F.col("witness").alias("_above"), F.col("root").alias("_top"))
    kept = [name for name in leaves.columns if name != "leaf"]
    return below.join(above, "tree").select(
        *kept, F.col("node").alias("leaf"), F.col("root").alias("subroot"), F.col("_top").alias("root"), F.concat("witness", "_above").alias("witness")
    )


def verified(listed: DataFrame, claimed: str = "claimed") -> DataFrame:
    """``listed`` (a manifest with a column of claimed leaves) with ``folded_root`` and ``verified``."""
    return listed.withColumn("folded_root", fold(F.col(claimed), F.col("witness"))).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Manifest of ``docs`` with leaves over ``LEAF_COLUMNS``, a tree per lang, and each leaf as claimed: of one row in seven
    (by the CRC-32 of the id) the claim counts one character more."""
    prepare(docs.sparkSession)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    longer = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    leaves = docs.select(
        F.col("lang").alias("group"), "doc_id", leaf(*LEAF_COLUMNS).alias("leaf"),
        F.when(changed & F.col("n_chars").isNotNull(), leaf(*longer)).alias("tampered"),
    )
    return manifest(leaves, block)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", source="string", lang="string", n_chars="long", text="string")
    listed = document_manifest(docs).withColumn("claimed", F.coalesce("tampered", "leaf"))
    return verified(listed).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), "folded_root", "verified"
    )


#: CRC-32 of the bytes of a text in SQL, for texts of ASCII characters: ``{0}`` is the text, ``crc`` a table
#: of one row with the 256 numbers ``t``, which the query has to join.
CRC_TABLE = """crc as (select list(list_reduce(list_prepend(i::ubigint, [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by i) as t from range(256) r(i))"""
CRC = """xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::ubigint)),
  lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::bigint])), 4294967295::ubigint)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"


SQL = f"""with recursive {CRC_TABLE},
leaves as (select doc_id, lang,
  sha256({" || ".join(map(_field, LEAF_COLUMNS))}) as leaf,
  case when n_chars is not null and {CRC.format("doc_id::varchar")} % 7 = 0
       then sha256({" || ".join(_field("n_chars + 1" if c == "n_chars" else c) for c in LEAF_COLUMNS)}) end as tampered
  from documents, crc),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from leaves),
trees(lang, level, place, node, n) as (
  select lang, 0, place, leaf, count(*) over (partition by lang) from placed
  union all
  select lang, level + 1, place // 2, sha256(string_agg(node, '' order by place)), (any_value(n) + 1) // 2
  from trees where n > 1 group by lang, level, place // 2),
subroots as (select lang, node, level, row_number() over (order by lang nulls first) - 1 as place from trees where n = 1),
tops(level, place, node, n) as (
  select 0, place, node, (select count(*) from subroots) from subroots
  union all
  select level + 1, place // 2, sha256(string_agg(node, '' order by place)), (any_value(n) + 1) // 2
  from tops where n > 1 group by level, place // 2),
steps as (
  select p.lang, p.place, t.level, s.node as sibling, (p.place >> t.level) & 1 as is_right
  from placed p join (select distinct lang, level from trees where n > 1) t on p.lang is not distinct from t.lang
  left join trees s on s.lang is not distinct from p.lang and s.level = t.level and s.place = xor(p.place >> t.level, 1)
  union all
  select p.lang, p.place, r.level + t.level, s.node, (r.place >> t.level) & 1
  from placed p join subroots r on r.lang is not distinct from p.lang
  join (select distinct level from tops where n > 1) t on true
  left join tops s on s.level = t.level and s.place = xor(r.place >> t.level, 1)),
folded(lang, place, level, node) as (
  select lang, place, 0, coalesce(tampered, leaf) from placed
  union all
  select f.lang, f.place, f.level + 1,
    sha256(case when is_right = 1 then coalesce(sibling, '') || node else node || coalesce(sibling, '') end)
  from folded f join steps s on s.lang is not distinct from f.lang and s.place = f.place and s.level = f.level),
proofs as (select lang, place, sha256(coalesce(string_agg(sibling, '' order by level), '')) as proof from steps group by lang, place)
select p.doc_id, p.leaf, r.node as subroot, t.node as root, coalesce(w.proof, sha256('')) as proof_sha256,
  f.node as folded_root, f.node = t.node as verified
from placed p join subroots r on r.lang is not distinct from p.lang
join (select node from tops where n = 1) t on true
left join proofs w on w.lang is not distinct from p.lang and w.place = p.place
join (select lang, place, arg_max(node, level) as node from folded group by lang, place) f
  on f.lang is not distinct from p.lang and f.place = p.place"""
