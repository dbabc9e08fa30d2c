"""Merkle manifest of a dataset as a nested-struct rollup.

Leaves are ranked within their group; a rank's base-8 digits say where the leaf hangs in a tree
of fan-out 8. The last digits are grouped away one after another inside blocks of ``8 ** DEPTH``
leaves: each grouping nests the child structs under their hash. Block roots are the leaves of
the next round, until each group is one block. Every block then hands its children their paths
by one nested transform and one explode, without joins; the only join is that of whole blocks
with their own path to the root, one row a block. Built-in functions throughout.

A path has an entry (left siblings, right siblings) for each level, so that a leaf is folded up
to the root by hashing left, own and right digest level by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.staging import stage

FANOUT = 8
DEPTH = 3  # digits grouped away in a round
BLOCK = FANOUT ** DEPTH
PATH = "array<struct<left:string,right:string>>"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the rank from 0 within ``group`` by ``order``, and ``n``, the group's size.

    One range shuffle deals the rows out in order, a large group over many partitions; a written
    table keeps their places, and the counts of (partition, group) give each its offset. Rows
    that are equal in ``order`` are dealt out at random. Runs a job.
    """
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_tie")]
    placed = rows.withColumn("_tie", F.rand(13)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = stage(placed.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("_group")
    runs = runs.select(
        "_group", "_part", (F.col("_first") - F.coalesce(F.sum("_rows").over(
            whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_base"),
        F.sum("_rows").over(whole).alias("n"))
    met = placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part")))
    return met.select(*rows.columns, (F.col("_at") - F.col("_base")).alias("idx"), "n")


def rollup(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """One row a block: ``grp, n, block, digest, tree`` from ``nodes(grp, idx, n, digest, *payload)``. Runs a job.

    A level is real while more than one node remains below it; else its only child passes through.
    """
    digits = [f"_d{i}" for i in range(DEPTH)]
    at = nodes.select(
        "grp", "n", F.expr(f"idx div {BLOCK}").alias("block"),
        *(F.expr(f"idx div {FANOUT ** i} % {FANOUT}").alias(d) for i, d in enumerate(digits)),
        F.struct("digest", *payload).alias("node")).repartition("grp", "block")
    for i, d in enumerate(digits):
        child = F.sort_array(F.collect_list(F.struct(d, "node")))
        at = at.groupBy("grp", "n", "block", *digits[i + 1:]).agg(child.alias("_c"))
        nested = F.transform("_c", lambda x: x["node"])
        below = F.transform(nested, lambda x: x["digest"])
        own = F.when(F.col("n") > FANOUT ** i, digest(F.array_join(below, ""))).otherwise(below[0])
        at = at.select("grp", "n", "block", *digits[i + 1:], F.struct(own.alias("digest"), nested.alias("nodes")).alias("node"))
    return stage(at.select("grp", "n", "block", F.col("node.digest").alias("digest"), F.col("node.nodes").alias("tree")), name)


def _step(nodes: Column, i: Column, real: Column) -> Column:
    """The path entry of child ``i`` of ``nodes``, as an array; empty where the level is not real."""
    below = F.transform(nodes, lambda x: x["digest"])
    entry = F.struct(
        F.array_join(F.slice(below, F.lit(1), i), "").alias("left"), F.array_join(F.slice(below, i + 2, F.lit(FANOUT)), "").alias("right"))
    return F.when(real, F.array(entry)).otherwise(F.array().cast(PATH))


def emitted(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """``grp, idx, digest, *payload, path, *rest`` of every child of ``blocks``, which hold their own ``path`` to the top."""
    rest = [c for c in blocks.columns if c not in ("grp", "n", "block", "digest", "tree", "path")]

    def leaves(nodes: Column, level: int, base: Column, above: Column) -> Column:
        def each(x: Column, i: Column) -> Column:
            path = F.concat(_step(nodes, i, F.col("n") > FANOUT ** level), above)
            if level:
                return leaves(x["nodes"], level - 1, base + i.cast("long") * FANOUT ** level, path)
            return F.struct((base + i).alias("idx"), x["digest"].alias("digest"), *(x[c].alias(c) for c in payload), path.alias("path"))

        out = F.transform(nodes, each)
        return F.flatten(out) if level else out

    children = leaves(F.col("tree"), DEPTH - 1, F.col("block") * BLOCK, F.col("path"))
    return blocks.select("grp", *rest, F.explode(children).alias("_x")).select("grp", "_x.*", *rest)


def paths(nodes: DataFrame, payload: list[str], largest: int, name: str, top) -> DataFrame:
    """``grp, idx, digest, *payload, path`` and the columns that ``top`` adds, for each of ``nodes(grp, idx, n, digest, *payload)``.

    ``top(roots)`` is given ``grp, digest`` of every group's root and returns ``grp, path`` and
    further columns. ``largest`` is the size of the largest group. Runs a job for each round,
    of which there are as many as digits of ``largest`` to the base ``BLOCK``.
    """
    rounds, held, at = [], payload, nodes
    while True:
        blocks = rollup(at, held, f"{name}-{len(rounds)}")
        rounds.append((blocks, held))
        if largest <= BLOCK:
            break
        at = blocks.select("grp", F.col("block").alias("idx"), F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("long").alias("n"), "digest")
        held, largest = [], -(-largest // BLOCK)
    above = top(rounds[-1][0].select("grp", "digest")).withColumn("idx", F.lit(0).cast("long"))
    for blocks, held in reversed(rounds):
        above = above.drop("digest").withColumnRenamed("grp", "_grp")
        met = blocks.join(above, blocks["grp"].eqNullSafe(above["_grp"]) & (F.col("block") == F.col("idx")))
        above = emitted(met.drop("_grp", "idx"), held)
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot of its language, root and proof of every row, and whether a tampered copy still verifies.

    ``docs`` holds ``doc_id, source, lang, n_chars, text``; other columns are not looked at. A
    row is a leaf, hashed over the five fields. Within a lang (null is one) leaves ascend by
    ``doc_id``, null first, then by leaf; equal rows are as many equal leaves. The subroots,
    by lang, are the leaves of the tree above. Tampering lower-cases A-Z of the texts whose
    ``crc32(doc_id)`` 3 divides; rows without an id are not tampered with. An empty table gives
    no rows. Runs jobs when called.
    """
    text = F.col("text")
    parts = [encoded(F.col(c)) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lower = F.translate(text, _UPPER, _LOWER)
    # Only a text that tampering changes has a second leaf.
    leaf, other = digest(F.concat(*parts)), F.when(hit & text.rlike("[A-Z]"), digest(F.concat(*parts[:-1], encoded(lower))))
    leaves = docs.select("doc_id", F.col("lang").cast("string").alias("grp"), leaf.alias("digest"), other.alias("tampered"))
    leaves = ranked(leaves, "grp", ["doc_id", "digest"], "leaves")
    largest = leaves.agg(F.max("n")).first()[0]
    if largest is None:
        nothing = leaves.select("doc_id", *(F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")))
        return nothing.withColumn("verified", F.lit(True))

    def subroots(roots: DataFrame) -> DataFrame:
        langs = ranked(roots.select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest"), "grp", ["lang"], "langs")
        last = paths(langs, ["lang"], langs.agg(F.max("n")).first()[0], "lang-tree", whole)
        return last.select(F.col("lang").alias("grp"), "path", F.col("digest").alias("subroot"), "root")

    def whole(root: DataFrame) -> DataFrame:
        return root.select("grp", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))

    out = paths(leaves, ["doc_id", "tampered"], largest, "doc-tree", subroots)
    proof = digest(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""))
    folded = F.aggregate("path", F.coalesce("tampered", "digest"), lambda own, p: digest(F.concat(p["left"], own, p["right"])))
    return out.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 8, lang_levels: int = 4) -> str:
    """The manifest of ``documents`` in DuckDB's SQL, for up to ``8 ** levels`` rows a lang and ``8 ** lang_levels`` langs."""

    def enc(x: str) -> str:
        return f"coalesce(strlen({x}::varchar) || ':' || {x}::varchar, '-')"

    def tree(name: str, group: str, levels: int) -> list[str]:
        out = []
        for k in range(levels):
            real, near = f"n > {8 ** k}", f"OVER (PARTITION BY {group}, i // 8 ORDER BY i ROWS BETWEEN"
            out.append(
                f"{name}_side{k} AS (SELECT {group}, i, {real} AS real, "
                f"if({real}, coalesce(string_agg(h, '') {near} UNBOUNDED PRECEDING AND 1 PRECEDING), ''), '') AS l, "
                f"if({real}, coalesce(string_agg(h, '') {near} 1 FOLLOWING AND UNBOUNDED FOLLOWING), ''), '') AS r FROM {name}{k})")
            out.append(
                f"{name}{k + 1} AS (SELECT {group}, i // 8 AS i, n, if({real}, sha256(string_agg(h, '' ORDER BY i)), min(h)) AS h "
                f"FROM {name}{k} GROUP BY {group}, i // 8, n)")
        return out

    def joins(name: str, key: str, at: str, levels: int) -> str:
        return " ".join(f"JOIN {name}_side{k} {name}{k} ON {key.format(f'{name}{k}')} AND {name}{k}.i = {at} // {8 ** k}" for k in range(levels))

    def fold(own: str, name: str, levels: int) -> str:
        return f"list_reduce([{own}{''.join(f', if({name}{k}.real, {name}{k}.l || chr(1) || {name}{k}.r, chr(2))' for k in range(levels))}], " \
               "lambda a, b: if(b = chr(2), a, sha256(replace(b, chr(1), a))))"

    def proof(name: str, levels: int) -> str:
        return " || ".join(f"{name}{k}.l || {name}{k}.r" for k in range(levels))

    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda s: ord(s)::bigint)), "
           "lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1]::bigint[], lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))))")
    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    head = " || ".join(enc(c) for c in FIELDS[:-1])
    steps = [
        f"leaves AS (SELECT doc_id, lang, sha256({head} || {enc('text')}) AS leaf, "
        f"if(coalesce({crc} % 3 = 0, false), sha256({head} || {enc(low)}), sha256({head} || {enc('text')})) AS tampered FROM documents)",
        "docs AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves)",
        "d0 AS (SELECT lang, i, n, leaf AS h FROM docs)", *tree("d", "lang", levels),
        f"langs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM d{levels})",
        "g0 AS (SELECT 0 AS g, i, n, subroot AS h FROM langs)", *tree("g", "g", lang_levels),
        f"upper_path AS (SELECT lang, subroot, g{lang_levels}.h AS root, langs.i AS place FROM langs, g{lang_levels})",
        f"met AS (SELECT doc_id, leaf, subroot, root, place, sha256_parts, {fold('tampered', 'd', levels)} AS folded FROM ("
        f"SELECT docs.*, {proof('d', levels)} AS sha256_parts, {', '.join(f'd{k}' for k in range(levels))} FROM docs "
        f"{joins('d', 'docs.lang IS NOT DISTINCT FROM {}.lang', 'docs.i', levels)}) x JOIN upper_path u ON u.lang IS NOT DISTINCT FROM x.lang)",
        f"done AS (SELECT doc_id, leaf, subroot, root, sha256(sha256_parts || {proof('g', lang_levels)}) AS proof_sha256, "
        f"{fold('folded', 'g', lang_levels)} AS folded_root FROM met {joins('g', '{}.g = 0', 'met.place', lang_levels)})",
    ]
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done"


ORACLE = oracle()
