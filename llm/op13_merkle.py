"""A Merkle manifest of a table: leaves, subroots per source, one root, and a proof per row.

Trees have ``FAN`` children to a node.  They are built and proved in superblocks: subtrees of
``BLOCK`` consecutive nodes.  On the way up every superblock is reduced to its top node, until
each source has one, its subroot; then the subroots are reduced the same way.  On the way
down the nodes of a superblock are cogrouped with the outer part of their proofs, which is
the proof of the superblock's top: the task repeats the local reduction, joins the inner and
the outer siblings, and folds the leaves with them.  A superblock has a bounded size however
large its source is; small sources share one.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import saved

FAN = 16
#: Levels of a superblock, and its nodes.
DEPTH = 3
BLOCK = FAN ** DEPTH
#: Rows whose crc32 of the doc_id this divides are tampered with before their proof is checked.
TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NODE = "tree string, pos bigint, n bigint, digest string, of_tree string, of_block bigint"
_OUTER = "tree string, pos bigint, lefts array<string>, rights array<string>, subroot string, root string"


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of the fields of a row, each as ``-`` if null, else its bytes, ``:``, and it."""
    def field(name):
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(name) for name in FIELDS]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of a row in its ``tree`` by ``order``, and ``n``, the tree's rows.

    Rows are dealt by ranges of the order, equal ones at random, so a tree with most of the
    rows is as many tasks as it needs; only counts per range and tree are summed across.
    """
    by = ["tree", *order]
    dealt = rows.repartitionByRange(*by, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions(*by)
    dealt = saved(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ranges")
    parts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", F.sum("c").over(tree).alias("n"),
                         (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(parts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def in_blocks(nodes: DataFrame) -> DataFrame:
    """Adds the superblock of every node, ``up_tree, up_block``: a run of ``BLOCK`` nodes of its
    tree, or, for a tree that is no larger, one that it shares with others by hash."""
    total = nodes.agg(F.count(F.lit(1))).first()[0]
    large = F.col("n") > BLOCK
    shared = F.pmod(F.xxhash64("tree"), F.lit(-(-total // BLOCK) or 1))
    return (nodes.withColumn("up_tree", F.when(large, F.concat(F.lit("="), "tree")).otherwise(""))
            .withColumn("up_block", F.when(large, F.floor(F.col("pos") / BLOCK)).otherwise(shared).cast("bigint")))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climbed(digests: list[str], n: int) -> list[list[str]]:
    """The levels of a superblock of a tree with n nodes, from the nodes to its top."""
    levels = [digests]
    while n > 1 and len(levels) <= DEPTH:
        below, n = levels[-1], -(-n // FAN)
        levels.append([_hash("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def _siblings(levels: list[list[str]], at: int):
    """What stands left and right of the path up from a node, level by level."""
    lefts, rights = [], []
    for level in levels[:-1]:
        first, inside = at - at % FAN, at % FAN
        run = level[first:first + FAN]
        lefts.append("".join(run[:inside]))
        rights.append("".join(run[inside + 1:]))
        at //= FAN
    return lefts, rights


def _trees(nodes: pd.DataFrame):
    for tree, rows in nodes.sort_values(["tree", "pos"]).groupby("tree", sort=False):
        yield tree, rows, _climbed(rows["digest"].tolist(), int(rows["n"].iloc[0]))


def reduced(nodes: DataFrame) -> DataFrame:
    """The top nodes of all superblocks; ``of_tree, of_block`` name the superblock."""
    def tops(key, block):
        rows = [(tree, rows["pos"].iloc[0] // BLOCK, -(-rows["n"].iloc[0] // BLOCK), levels[-1][0], *key)
                for tree, rows, levels in _trees(block)]
        return pd.DataFrame(rows, columns=["tree", "pos", "n", "digest", "of_tree", "of_block"])

    columns = ["up_tree", "up_block", "tree", "pos", "n", "digest"]
    return nodes.select(*columns).groupBy("up_tree", "up_block").applyInPandas(tops, _NODE)


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes with their superblocks, tier by tier, and the tops of all trees."""
    tiers = [saved(in_blocks(nodes), "tier")]
    while True:
        top = saved(reduced(tiers[-1]), "nodes")
        if (top.agg(F.max("n")).first()[0] or 1) == 1:
            return tiers, top
        tiers.append(saved(in_blocks(top), "tier"))


def _cogrouped(nodes: DataFrame, outer: DataFrame, each, schema: str) -> DataFrame:
    """``each(row, lefts, rights, top)`` of every node, with its whole proof and the row of
    ``outer`` of its superblock's top."""
    def finish(block, tops):
        tops = {(t.tree, t.pos): t for t in tops.itertuples(index=False)}
        found = []
        for tree, rows, levels in _trees(block):
            top = tops[tree, rows["pos"].iloc[0] // BLOCK]
            for at, row in enumerate(rows.itertuples(index=False)):
                lefts, rights = _siblings(levels, at)
                found.append(each(row, [*lefts, *top.lefts], [*rights, *top.rights], top))
        return pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])

    by = ["up_tree", "up_block"]
    return nodes.groupBy(*by).cogroup(outer.groupBy(*by)).applyInPandas(finish, schema)


def _below(outer: DataFrame) -> DataFrame:
    """Proofs of top nodes by the superblocks that the nodes stand for."""
    return outer.withColumnsRenamed({"of_tree": "up_tree", "of_block": "up_block"})


def _descend(tiers: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Proofs of the nodes of all tiers but the first, from those of the tops."""
    schema = _OUTER + ", of_tree string, of_block bigint"
    each = lambda row, lefts, rights, top: (row.tree, row.pos, lefts, rights, top.subroot, top.root, row.of_tree, row.of_block)
    for tier in reversed(tiers[1:]):
        outer = _below(saved(_cogrouped(tier, outer, each, schema), "proofs"))
    return outer


def manifest(docs: DataFrame, tampered: int = TAMPERED, proofs: bool = False) -> DataFrame:
    """``doc_id, source, pos, leaf, subroot, root, proof_sha256, folded_root, verified`` of every
    row, ``pos`` its place in the source; with ``proofs`` also ``lefts`` and ``rights``, the
    siblings on either side of its path, level by level.

    A leaf hashes ``doc_id, source, lang, n_chars, text``.  Leaves of a source ascend by doc_id
    (null first, then by digest: repeated rows are leaves each); runs of ``FAN`` consecutive
    nodes become their hash until one is left, the subroot; subroots by source (null first,
    UTF-8 bytewise) likewise give the root.  A lone leaf is the subroot, a lone subroot the
    root; an empty table gives no rows.  ``folded_root`` is refolded from the leaf of the
    tampered row (A-Z of the text in lower case, where ``tampered`` divides the crc32 of the
    doc_id, never of a null one).  Other columns are not read.
    """
    text = F.translate("text", _UPPER, _LOWER)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tampered == 0
    leaves = saved(docs.select(
        "doc_id", F.col("doc_id").cast("string").alias("id"), "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), leaf_digest().alias("digest"), F.when(hit, leaf_digest(text=text)).alias("tampered")), "leaves")
    tiers, subroots = _climb(numbered(leaves, ["doc_id", "digest"]))
    # the subroots are the nodes of one more tree; sources keep their order as its keys
    sources = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "of_tree", "of_block"), ["name"])
    upper, root = _climb(sources)
    outer = root.select(F.col("of_tree").alias("up_tree"), F.col("of_block").alias("up_block"), "tree", "pos",
                        F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"),
                        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    outer = _descend(upper, outer)
    each = lambda row, lefts, rights, top: (row.name, 0, lefts, rights, row.digest, top.root, row.of_tree, row.of_block)
    outer = _below(saved(_cogrouped(upper[0], outer, each,
                                    _OUTER + ", of_tree string, of_block bigint"), "proofs"))
    outer = _descend(tiers, outer)

    def verified(row, lefts, rights, top):
        node = row.digest if row.tampered is None else row.tampered
        for left, right in zip(lefts, rights):
            node = _hash(left + node + right)
        proof = _hash("".join(left + right for left, right in zip(lefts, rights)))
        found = (row.id, row.source, row.pos, row.digest, top.subroot, top.root, proof, node, node == top.root)
        return (*found, lefts, rights) if proofs else found

    schema = ("id string, source string, pos bigint, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string, verified boolean")
    schema += ", lefts array<string>, rights array<string>" * proofs
    # ids travel as text: pandas has no column of whole numbers with nulls
    rows = _cogrouped(tiers[0].drop("doc_id"), outer, verified, schema)
    return rows.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), *rows.columns[1:])


def q_op13_merkle(spark, sf_dir):
    rows = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _field(x: str) -> str:
    return f"case when {x} is null then '-' else octet_length(encode({x})) || ':' || {x} end"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in (
        "cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)) + ")"


_STEP = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"

SQL = f"""
with recursive
digits as (select doc_id, source, lang, n_chars, text,
    xor(list_reduce(list_prepend(4294967295::bigint, [ascii(d)::bigint for d in string_split(cast(doc_id as varchar), '')]),
        lambda c, b: {_STEP}), 4294967295::bigint) as crc from documents),
leaves as (select row_number() over () as id, doc_id, coalesce('=' || source, '') as k, {_leaf('text')} as leaf,
    case when crc % {TAMPERED} = 0 then {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} end as tampered from digits),
placed as (select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by k) as n from leaves),
t as (select 0 as lvl, k, pos, leaf as d, n from placed
    union all select lvl + 1, k, pos // 16, sha256(string_agg(d, '' order by pos)), (n + 15) // 16 from t where n > 1 group by lvl, k, pos // 16, n),
sub as (select k, d as subroot, row_number() over (order by k) - 1 as spos, count(*) over () as sn from t where n = 1),
u as (select 0 as lvl, spos as pos, subroot as d, sn as n from sub
    union all select lvl + 1, pos // 16, sha256(string_agg(d, '' order by pos)), (n + 15) // 16 from u where n > 1 group by lvl, pos // 16, n),
gt as (select lvl, k, pos // 16 as g, list(d order by pos) as ds from t where n > 1 group by all),
gu as (select lvl, pos // 16 as g, list(d order by pos) as ds from u where n > 1 group by all),
a as (select id, k, 0 as lvl, pos, coalesce(tampered, leaf) as node, '' as proof from placed
    union all select id, a.k, a.lvl + 1, pos // 16,
        sha256(array_to_string(ds[1:pos % 16], '') || node || array_to_string(ds[pos % 16 + 2:], '')),
        proof || array_to_string(ds[1:pos % 16], '') || array_to_string(ds[pos % 16 + 2:], '')
    from a join gt on gt.lvl = a.lvl and gt.k = a.k and gt.g = pos // 16),
a_end as (select a.* from a qualify row_number() over (partition by id order by lvl desc) = 1),
b as (select id, 0 as lvl, spos as pos, node, proof from a_end join sub using (k)
    union all select id, b.lvl + 1, pos // 16,
        sha256(array_to_string(ds[1:pos % 16], '') || node || array_to_string(ds[pos % 16 + 2:], '')),
        proof || array_to_string(ds[1:pos % 16], '') || array_to_string(ds[pos % 16 + 2:], '')
    from b join gu on gu.lvl = b.lvl and gu.g = pos // 16),
b_end as (select b.* from b qualify row_number() over (partition by id order by lvl desc) = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, node as folded_root, node = root as verified
from leaves join sub using (k) join b_end using (id) cross join (select d as root from u where n = 1)
"""
