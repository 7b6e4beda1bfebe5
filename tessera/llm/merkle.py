"""A Merkle tree over a dataset, and proofs of its rows by the preimages of their ancestors.

Every row is a leaf. The leaves of a group, in the order of a key, are hashed eight at a time, level by level, to the group's subroot; the
subroots, in the groups' order, to the root. For every parent the concatenation of its children's hashes is stored, its preimage. A
leaf is joined to the preimages of all its ancestors, from its parent to the root, each with the number of the slot of 64 characters that is
its own ancestor's there. The preimages without these slots are its siblings; another hash put into the first slot, hashed, put
into the next one and so on gives the root that a changed leaf would lead to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

ARITY = 8
WIDTH = 64  # characters of a hash
PATH = "array<struct<slot: int, preimage: string>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text's UTF-8 bytes."""
    return F.sha2(text, 256)


def leaf(*values: Column) -> Column:
    """The hash of a row: of each value `-` if it is null, else the count of its bytes, a colon and the value, so that no two rows have
    the same text."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


@dataclass(frozen=True)
class Tree:
    """levels: for each level the nodes of all groups (group, i, n, hash, and preimage above the leaves), i counting from 0 among the group's n nodes
    of the level; the leaves' table has the rows' other columns besides. Written tables all."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """group and root of each group."""
        out = [t.where("n = 1").select("group", F.col("hash").alias("root")) for t in self.levels]
        top = out[0]
        for t in out[1:]:
            top = top.unionByName(t)
        return top


def build(leaves: DataFrame, order: list[str]) -> Tree:
    """The trees of leaves (group string, not null; hash; further columns), one for each group, its leaves in the order given. Leaves that tie
    in the order come by their hash; equal leaves are alike wherever they come. A level is written before the next is made; a group
    may hold all the rows, for leaves are numbered by ranges and a parent sees its own children only."""
    own = common.fresh(leaves, "row")
    rows = leaves.withColumn(own, F.monotonically_increasing_id())
    base = common.ranked(rows, ["group"], [*order, "hash", own], "i").drop(own).withColumnRenamed("i_of", "n")
    levels = [common.stage(base, "leaves")]
    most = levels[0].agg(F.max("n")).first()[0] or 0  # one number
    while most > 1:
        child = F.struct(F.pmod("i", F.lit(ARITY)).alias("slot"), "hash")
        up = levels[-1].where("n > 1").groupBy("group", F.expr(f"i div {ARITY}").alias("i"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
        up = up.agg(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: c["hash"]), "").alias("preimage"))
        levels.append(common.stage(up.withColumn("hash", digest(F.col("preimage"))), "level"))
        most = -(-most // ARITY)
    return Tree(levels)


def paths(tree: Tree, above: DataFrame | None = None) -> DataFrame:
    """The leaves' rows with `path`, the preimages of their ancestors from the parent up, each with the slot that leads to the leaf. `above`
    (group and path, and further columns for the leaves) says how the paths of groups' roots go on.

    Paths are handed down: a level is joined to the one above it, an eighth of its size, and the leaves to their parents' once."""
    extra = [c for c in above.columns if c not in ("group", "path")] if above is not None else []
    upper = None
    for t in reversed(tree.levels):
        top = t.where("n = 1")
        top = top.join(above, "group") if above is not None else top.withColumn("path", F.array().cast(PATH))
        if upper is not None:
            parents = upper.select(F.col("group").alias("__group"), F.col("i").alias("__i"), F.col("preimage").alias("__preimage"), F.col("path").alias("__path"), *extra)
            inner = t.where("n > 1").join(parents, (F.col("group") == F.col("__group")) & (F.expr(f"i div {ARITY}") == F.col("__i")))
            step = F.array(F.struct(F.pmod("i", F.lit(ARITY)).cast("int").alias("slot"), F.col("__preimage").alias("preimage")))
            inner = inner.withColumn("path", F.concat(step, F.col("__path").cast(PATH))).drop("__group", "__i", "__preimage", "__path")
            top = top.unionByName(inner)
        upper = top
    return upper


def siblings(path: Column) -> Column:
    """The siblings' hashes along a path, level by level, left to right, as one text: each preimage without its own slot."""
    cut = lambda p: F.concat(F.substr(p["preimage"], F.lit(1), p["slot"] * WIDTH), F.substr(p["preimage"], p["slot"] * WIDTH + WIDTH + 1))
    return F.array_join(F.transform(path, cut), "")


def folded(hash: Column, path: Column) -> Column:
    """The root that a leaf with this hash and the siblings of this path leads to."""
    left = lambda p: F.substr(p["preimage"], F.lit(1), p["slot"] * WIDTH)
    right = lambda p: F.substr(p["preimage"], p["slot"] * WIDTH + WIDTH + 1)
    return F.aggregate(path, hash, lambda h, p: digest(F.concat(left(p), h, right(p))))


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", key: str = "doc_id", changed: dict[str, Column] | None = None) -> DataFrame:
    """key, group, leaf, subroot, root, path, and changed_leaf: a row for each row of docs.

    `changed` gives new values for fields; changed_leaf is the leaf with these (the leaf itself without them). Leaves go by key within their
    group, those with a null key first; the groups by the bytes of their name, null first. Repeated rows are leaves of their own with equal
    hashes. Null fields are hashed as such, an empty or long text by its bytes. An empty table gives no rows. Further columns of docs are neither read nor
    returned.
    """
    values = {f: F.col(f) for f in fields}
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(
        named.alias("group"), F.col(key).alias("__key"), F.col(group).alias("__name"),
        leaf(*values.values()).alias("hash"), (leaf(*(values | changed).values()) if changed else F.lit(None).cast("string")).alias("changed_leaf"),
    )
    tree = build(common.stage(rows, "rows"), ["__key"])
    subroots = tree.roots().select(F.lit("").alias("group"), F.col("group").alias("__of"), F.col("root").alias("hash"))
    crown = build(subroots, ["__of"])
    tops = paths(crown).select(F.col("__of").alias("group"), "path", F.col("hash").alias("subroot"))
    tops = tops.crossJoin(F.broadcast(crown.roots().select("root")))  # one row
    out = paths(tree, common.stage(tops, "crown"))
    return out.select(F.col("__key").alias(key), F.col("__name").alias(group), F.col("hash").alias("leaf"), "subroot", "root", "path", F.coalesce("changed_leaf", "hash").alias("changed_leaf"))
