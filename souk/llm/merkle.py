"""Merkle manifest of a table: a proof for every row.

``leaf`` hashes the fields of a row.  ``manifest`` orders the leaves of each
group by id and hashes them upwards: per level, windows over the runs of
``fanout`` neighbouring nodes give each node its siblings as fixed-offset lag
and lead columns, masked by the node's slot and the length of its run, and
the first row of a run hashes it into the parent.  A group's last node is its
subroot; the subroots, ordered by group, are hashed in the same way into the
root.  ``fold`` recomputes the root from a leaf and its proof.

A proof lists, from the leaf's level to the root, the hashes left and right
of the node in its run, each side concatenated (empty in a run of one).

Places come from the split row numbers of :mod:`souk.operators.ordered`, so a
group may hold most of the rows; after that every window and join is keyed by
(group, run).  Each level is written to the shared work folder, an eighth of
the level below; proofs are joined downwards from the few upper nodes.

Defined results: an empty table gives no rows; a NULL group is a group and
comes first; NULL ids come first in their group; rows with one id are ordered
by leaf (equal rows have equal leaves, in any order); a lone leaf is its
subroot and a lone subroot the root, with no proof entry for that step.  Texts
are hashed whole.  Columns other than ``keep`` are not read; ``keep`` may use
any name but ``leaf``, ``subroot``, ``root`` and ``proof``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.shared import stage
from souk.operators.ordered import asc, rank_within

FANOUT = 8


def digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """Hash of ``fields`` in order: ``-`` for NULL, else UTF-8 byte count,
    ``:``, value (no two rows of different fields give one input)."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))
    return digest(F.concat(*[part(f) for f in fields]))


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` leads to through ``proof``."""
    return F.aggregate(proof, start, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def siblings(proof: Column) -> Column:
    """All hashes of a proof in order, concatenated."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def _sides(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (g, place, n, node) with the concatenated hashes ``left`` and
    ``right`` of each node in its ``run``."""
    slot = F.col("place") % fanout
    length = F.least(F.lit(fanout), F.col("n") - F.col("run") * fanout)
    w = Window.partitionBy("g", "run").orderBy("place")
    before = [F.when(slot >= k, F.lag("node", k).over(w)) for k in range(fanout - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("node", k).over(w)) for k in range(1, fanout)]
    return (nodes.withColumn("run", (F.col("place") / fanout).cast("long"))
            .withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)}))


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: the first node of each run hashes the run."""
    first = _sides(nodes.where(F.col("n") > 1), fanout).where(F.col("place") % fanout == 0)
    return first.select("g", F.col("run").alias("place"), F.ceil(F.col("n") / fanout).alias("n"),
                        digest(F.concat("node", "right")).alias("node"))


def _climb(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Staged levels above ``nodes`` and the last node (g, top) of each group."""
    size = nodes.agg(F.max("n")).first()[0] or 0        # one number: how many levels to write
    levels, tops = [], nodes.where(F.col("n") == 1).select("g", F.col("node").alias("top"))
    while size > 1:
        nodes = stage(_parents(nodes, fanout), f"{name}-{len(levels) + 1}")
        levels.append(nodes)
        tops = tops.unionByName(nodes.where(F.col("n") == 1).select("g", F.col("node").alias("top")))
        size = -(-size // fanout)
    return levels, tops


def _proofs(leaves: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """``leaves`` with the proof up to their group's last node."""
    step = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array())
    above = None
    for nodes in reversed([leaves, *levels]):
        here = _sides(nodes if nodes is leaves else nodes.where(F.col("n") > 1), fanout)
        if above is None:
            found = here.withColumn("proof", step)
        else:
            found = (here.join(above, ["g", "run"], "left")
                     .withColumn("proof", F.concat(step, F.coalesce("above", F.array().cast(_PROOF)))))
        above = found.select("g", F.col("place").alias("run"), F.col("proof").alias("above"))
    return found.drop("run", "left", "right")


_PROOF = "array<struct<left: string, right: string>>"


def manifest(rows: DataFrame, id_col: str, group_col: str, leaf_col: str = "leaf", keep: Sequence[str] = (),
             fanout: int = FANOUT, max_rows: int | None = None) -> DataFrame:
    """Per row of ``rows``: ``id_col``, ``leaf``, ``subroot``, ``root``,
    ``proof`` (array of left, right) and the columns ``keep``.

    ``leaf_col`` holds the rows' hashes (see :func:`leaf`).  ``max_rows``:
    rows of a group numbered in one task, see ``souk.operators.ordered``."""
    extra = F.struct(F.lit(0).alias("_"), *keep)
    # written first: the texts are read and hashed once, and the count is known
    narrow = stage(rows.select(F.struct(F.col(group_col).alias("key")).alias("g"), F.col(id_col).alias("id"),
                               F.col(leaf_col).alias("node"), extra.alias("extra")), "merkle-leaves")
    numbered = stage(rank_within(narrow, ["g"], [asc("id"), asc("node")], "place", "row_number", max_rows,
                                 narrow.count()), "merkle-places")
    sizes = numbered.groupBy("g").agg(F.max("place").alias("n"))
    leaves = numbered.join(sizes, "g").withColumn("place", F.col("place") - 1)
    levels, tops = _climb(leaves, fanout, "merkle")

    # the subroots, in the order of their groups, are the leaves of the last tree
    tops = stage(tops.select("g", "top", F.col("g.key").alias("key")), "merkle-tops")
    n_groups = tops.count()
    subroots = stage(rank_within(tops, [], [asc("key")], "place", "row_number", max_rows, n_groups).select(
        F.lit(0).alias("g"), (F.col("place") - 1).alias("place"), F.lit(n_groups).cast("long").alias("n"),
        F.col("top").alias("node"), F.col("g").alias("group")), "merkle-subroots")
    upper, root = _climb(subroots, fanout, "merkle-root")
    ends = (_proofs(subroots, upper, fanout).join(root.select("g", F.col("top").alias("root")), "g")
            .select(F.col("group").alias("g"), F.col("node").alias("subroot"), "root", F.col("proof").alias("to_root")))
    return (_proofs(leaves, levels, fanout).join(ends, "g")
            .select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root",
                    F.concat("proof", "to_root").alias("proof"), *[F.col("extra")[k].alias(k) for k in keep]))
