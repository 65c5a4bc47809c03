"""A Merkle manifest of a dataset: one hash tree a part, its upper levels hashed by butterfly exchange.

Every row is a leaf.  A part's leaves stand in key order; ``FANOUT`` consecutive nodes become their parent until one,
the part's subroot, is left; the subroots in part order likewise become the root.  Leaves are cut into aligned chunks
of whole subtrees, and a chunk's own levels are hashed where its leaves are.  Above them chunks work in rounds: in each,
the aligned groups of ``FANOUT`` subtrees swap their nodes, member by member (the chunks with the same place within
their subtrees), so that every chunk hashes all its ancestors itself and holds its whole upper proof at the end; no
second pass goes down the tree.  A part of a third of all rows is many chunks; nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, written

FANOUT = 8
#: Levels that are hashed within a chunk: it has FANOUT ** CHUNK_LEVELS leaves.
CHUNK_LEVELS = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the values: each ``-`` if null, else its UTF-8 byte count, ``:`` and itself as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _joined(nodes: Column) -> Column:
    return F.sha2(F.concat_ws("", nodes), 256)


def _run(nodes: Column, parent: Column, fanout: int) -> Column:
    return F.slice(nodes, (parent * fanout + 1).cast("int"), F.lit(fanout))


def _positions(leaves: DataFrame, part: str, order: list[str]) -> DataFrame:
    """``leaves`` with ``pos``, their place (from 0) within the part, and ``n``, its number of leaves.

    Rows are sorted in ranges of (part, ``order``), so that a large part lies in many; counts of the parts within each range say
    where a range's share of a part begins.  They are joined on (range, part), which holds no more rows than a range does.
    """
    by = [F.col(c).asc_nulls_first() for c in [part, *order]]
    rows = written(leaves.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__range", F.shiftright("__at", 33))
    w = Window.partitionBy("__p")  # a row a range
    cells = rows.groupBy(F.col("__range").alias("__r"), F.col(part).alias("__p")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    cells = written(cells.withColumns({"__before": F.coalesce(F.sum("__n").over(w.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                                       "n": F.sum("__n").over(w)}))
    j = rows.join(cells, (F.col("__range") == F.col("__r")) & F.col(part).eqNullSafe(F.col("__p")))
    return j.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__range", "__r", "__p", "__n", "__first", "__before")


def _chunks(leaves: DataFrame, part: str, carry: list[str], fanout: int, chunk_levels: int) -> DataFrame:
    """A row a chunk: ``leaves`` (structs of ``leaf`` and ``carry``, in order), ``levels`` (nodes of its own levels, the
    leaves first), ``node`` (its root) and ``n_chunks`` of its part.  ``leaves`` has ``pos`` and ``n`` of the part."""
    size = fanout ** chunk_levels
    rows = leaves.groupBy(F.col(part), F.expr(f"pos div {size}").alias("chunk"), F.expr(f"(n + {size - 1}) div {size}").alias("n_chunks")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "leaf", *carry))).alias("leaves"))  # at most `size` rows
    rows = rows.withColumn("levels", F.array(F.col("leaves.leaf")))
    top = F.element_at("levels", -1)
    up = F.transform(F.sequence(F.lit(0), F.expr(f"(size(element_at(levels, -1)) - 1) div {fanout}").cast("int")), lambda i: _joined(_run(top, i, fanout)))
    for _ in range(chunk_levels):  # a part of one chunk ends where one node is left; a chunk among others goes on
        rows = rows.withColumn("levels", F.when((F.col("n_chunks") > 1) | (F.size(top) > 1), F.concat("levels", F.array(up))).otherwise(F.col("levels")))
    return rows.withColumn("node", F.element_at(F.element_at("levels", -1), 1))


def _exchange(chunks: DataFrame, part: str, fanout: int) -> DataFrame:
    """(part, chunk, ``top``, ``path``) of every chunk by butterfly rounds: the part's last node and, for each level
    above the chunk's, the run of nodes and the own place in it.

    In a round, chunk c belongs to the subtree c div fanout^r and has the place c mod fanout^r in it.  Those of one
    place in the up to ``fanout`` subtrees of a group meet, and each hashes the parent.  The last subtree may have fewer
    chunks than the others; its chunks also send its node to the places that it lacks.
    """
    state = written(chunks.select(part, "chunk", "n_chunks", F.col("node").alias("top"),
                                  F.expr("cast(array() as array<struct<run: array<string>, own: int>>)").alias("path")))
    most = state.agg(F.max("n_chunks")).first()[0] or 1
    width = 1
    while width < most:
        group = F.expr(f"chunk div {width * fanout}")
        subtree, place = F.expr(f"chunk div {width}"), F.expr(f"chunk % {width}")
        have = F.least(F.lit(width).cast("long"), F.col("n_chunks") - subtree * width)  # chunks of this subtree
        alone = F.col("n_chunks") <= group * width * fanout + width  # no other subtree in the group
        to = F.when(alone, F.array(place)).otherwise(F.sequence(place, F.lit(width - 1).cast("long"), have))
        sent = state.select("*", group.alias("__group"), (subtree % fanout).cast("int").alias("__own"), place.alias("__place"), F.explode(to).alias("__to"))
        mine = F.when(F.col("__to") == F.col("__place"), F.struct("chunk", "path"))
        met = sent.groupBy(part, "n_chunks", "__group", "__to").agg(F.sort_array(F.collect_list(F.struct(  # at most `fanout` rows
            F.col("__own"), F.col("top"), mine.alias("mine")))).alias("met"))
        met = met.withColumn("run", F.col("met.top")).select("*", F.explode(F.filter("met", lambda x: x["mine"].isNotNull())).alias("me"))
        grown = F.concat("me.mine.path", F.array(F.struct(F.col("run"), F.col("me.__own").alias("own"))))
        done = F.col("n_chunks") <= width  # one node was left before this round
        state = written(met.select(part, F.col("me.mine.chunk").alias("chunk"), "n_chunks", F.when(done, F.col("me.top")).otherwise(_joined(F.col("run"))).alias("top"),
                                   F.when(done, F.col("me.mine.path")).otherwise(grown).alias("path")))
        width *= fanout
    return state.select(part, "chunk", "top", "path")


def _own_path(levels: Column, j: Column, fanout: int, chunk_levels: int) -> Column:
    """The path of leaf ``j`` of a chunk up to the chunk's root."""
    steps = F.array(*[F.struct(F.lit(fanout ** r).cast("long").alias("w"), F.lit(r).alias("r")) for r in range(chunk_levels)])
    steps = F.slice(steps, F.lit(1), F.size(levels) - 1)
    return F.transform(steps, lambda s: F.struct(_run(F.get(levels, s["r"]), F.floor(j / (s["w"] * fanout)), fanout).alias("run"),
                                                 (F.floor(j / s["w"]) % fanout).cast("int").alias("own")))


def siblings(path: Column) -> Column:
    """All sibling hashes of a path, level by level and left to right, as one text."""
    return F.concat_ws("", F.flatten(F.transform(path, lambda s: F.filter(s["run"], lambda _, i: i != s["own"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give: at each level the own place in the run is taken by what was hashed so far."""
    return F.aggregate(path, leaf, lambda h, s: _joined(F.transform(s["run"], lambda x, i: F.when(i == s["own"], h).otherwise(x))))


def merkle_manifest(docs: DataFrame, columns: list[str], key: str = "doc_id", part: str = "lang", *, tampered: dict[str, Column] | None = None,
                    where: Column | None = None, fanout: int = FANOUT, chunk_levels: int = CHUNK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """(leaves, parts) of the hash tree over ``docs``.

    leaves  a row for each row of ``docs``: ``key`` and ``part`` as ``key`` and ``part``, ``leaf`` (the digest of ``columns``), ``pos`` (place
            in the part), ``subroot``, ``root``, ``n_siblings``, ``proof_sha256`` (of all sibling hashes up to the root), ``folded_root`` (the root recomputed
            from the proof and the row's leaf, where ``where`` holds with the columns ``tampered``, {name: expression}, in place of its own) and ``verified`` (that this equals the root).
    parts   ``part``, ``n`` leaves, ``subroot`` and ``root``: the manifest itself.

    Null keys come first, then rows of one key by their leaf; rows that are equal in all columns keep any order, which
    changes no hash.  Null parts form a part of their own, the first.  A null value differs from an empty text.  Texts are
    hashed whole, within the JVM.  Columns of ``docs`` that aren't named aren't read, so clashing names do no harm.  An
    empty table gives no leaves and no parts.
    """
    values = [col(c) for c in columns]
    changed = [(tampered or {}).get(c, col(c)) for c in columns]
    hashed = digest(values)
    other = hashed if where is None else F.when(where, digest(changed)).otherwise(hashed)
    leaves = written(docs.select(col(part).cast("string").alias("part"), col(key).alias("key"), hashed.alias("leaf"),
                                 other.alias("other"), F.monotonically_increasing_id().alias("row")))
    placed = _positions(leaves, "part", ["key", "leaf", "row"])
    chunks = written(_chunks(placed, "part", ["key", "other"], fanout, chunk_levels))
    upper = _exchange(chunks, "part", fanout)
    # the subroots are the leaves of the upper tree
    parts = written(chunks.groupBy("part").agg(F.sum(F.size("leaves")).alias("n_leaves")).join(
        upper.filter("chunk = 0").select(F.col("part").alias("__p"), F.col("top").alias("leaf")), F.col("part").eqNullSafe(F.col("__p"))).drop("__p"))
    over = _positions(parts.withColumn("tree", F.lit(0)), "tree", ["part"])
    over = written(_chunks(over, "tree", ["part", "n_leaves"], fanout, chunk_levels))
    top = _exchange(over, "tree", fanout)
    each = over.join(top.select("chunk", F.col("top").alias("root"), F.col("path").alias("above")), "chunk").select(
        "root", "above", "levels", F.posexplode("leaves").alias("__j", "x"))
    each = written(each.select(F.col("x.part").alias("part"), F.col("x.n_leaves").alias("n"), F.col("x.leaf").alias("subroot"), "root", F.concat(
        _own_path(F.col("levels"), F.col("__j"), fanout, chunk_levels), "above").alias("above")))
    path = upper.join(each.select(F.col("part").alias("__p"), "subroot", "root", "above"), F.col("part").eqNullSafe(F.col("__p"))).select(
        F.col("part").alias("__part"), F.col("chunk").alias("__chunk"), "subroot", "root", F.concat("path", "above").alias("path"))
    j = chunks.join(path, F.col("part").eqNullSafe(F.col("__part")) & (F.col("chunk") == F.col("__chunk")))
    rest = siblings(F.col("path"))  # of the whole chunk
    j = j.withColumns({"rest": rest, "n_rest": F.aggregate("path", F.lit(0), lambda n, s: n + F.size(s["run"]) - 1)})

    def proof(x: Column, i: Column) -> Column:
        own = _own_path(F.col("levels"), i, fanout, chunk_levels)
        return F.struct(x["key"].alias("key"), x["leaf"].alias("leaf"), x["pos"].alias("pos"), F.sha2(F.concat(siblings(own), "rest"), 256).alias("proof_sha256"),
                        (F.aggregate(own, F.lit(0), lambda n, s: n + F.size(s["run"]) - 1) + F.col("n_rest")).alias("n_siblings"),
                        fold(fold(x["other"], own), F.col("path")).alias("folded_root"))

    out = j.select("part", "subroot", "root", F.inline(F.transform("leaves", proof)))
    out = out.withColumn("verified", F.col("folded_root") == F.col("root"))
    return out.select("key", "part", "pos", "leaf", "subroot", "root", "n_siblings", "proof_sha256", "folded_root", "verified"), each.drop("above")


def lowered(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def chosen(doc_id: Column) -> Column:
    """True where 3 divides crc32(doc_id as text); a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 0
