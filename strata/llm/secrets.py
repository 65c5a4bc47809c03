"""Secret scans with multipart credential linking, in DataFrame functions only.

Patterns that are secrets by themselves (the base kinds) are reported wherever they stand.  A credential often has
several parts, each of which is harmless or too common alone: an identifier, a secret and an endpoint.  Such weak
candidates are parts too, and parts are joined by interval: two are in one scope if their starts are at most ``reach``
code points apart.  A weak part is reported only if its scope holds a base part of another role, or parts of both
other roles.  The join is on cells of ``reach`` code points of a document: a part meets its own cell and the two next to
it, and a cell has a bounded number of parts, so neither a long text nor a common passage makes a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, without, written

#: Code points between the starts of parts that belong together.
REACH = 200
_SCAN = 1000


def _either(words: str) -> str:
    """The pattern of a list of words whose letters (A-Z only) stand in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _set(names: str, values: str) -> str:
    """A name, perhaps quoted, then ``:`` or ``=`` and a value, whose first quote is no part of it."""
    return f"""({_either(names)})["']?\\x20*[:=]\\x20*["']?({values})"""


_VALUE = "[A-Za-z0-9+/_.=-]+"
# Fixed values, in the order in which kinds are listed: kind -> (role, whether it is reported by itself, pattern, group of the value, its least length).
KINDS = {
    "assign": ("secret", True, _set("password|passwd|secret|token|api_?key", _VALUE), 2, 6),
    "access": ("identifier", True, "AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("secret", True, "[0-9a-f]{24,}", 0, 24),
    "ident": ("identifier", False, _set("user_?name|user_?id|user|login|account_?id|client_?id|access_?key_?id|key_?id", "[A-Za-z0-9@+/_.=-]+"), 2, 3),
    "phrase": ("secret", False, _set("pwd|pass|passphrase|auth|credential|private_?key|access_?key", _VALUE), 2, 4),
    "opaque": ("secret", False, "[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
    "endpoint": ("endpoint", False, "(https?|s?ftp|ssh|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqps?|s3a?)://[A-Za-z0-9@:/%._~+-]+|"
                 + _set("host|hostname|endpoint|server", "[A-Za-z0-9@:/%._~+-]+"), 0, 8),
}
BASE = [k for k, (_, base, *_) in KINDS.items() if base]
_KIND_NO = {k: i for i, k in enumerate(KINDS)}


def _prefix_sums(steps: Column) -> Column:
    """The sums of all steps before each, in runs, so that a long array costs much less than its square."""
    def scan(a: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), F.expr("cast(array() as array<bigint>)").alias("sums"))
        return F.aggregate(a, first, lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["sums"], F.array(acc["sum"])).alias("sums")), lambda acc: acc["sums"])

    zero = F.lit(0).cast("long")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _SCAN).cast("int")), lambda i: F.slice(steps, i * _SCAN + 1, F.lit(_SCAN)))
    starts = scan(F.transform(runs, lambda r: F.aggregate(r, zero, lambda s, x: s + x)), zero)
    return F.flatten(F.zip_with(runs, starts, scan))


def _spans(kind: str, matches: Column, gaps: Column) -> Column:
    """(start, kind_no, end) of the matches that count; ``gaps`` are the lengths of the text before each match and after the last."""
    _, _, pattern, group, least = KINDS[kind]
    length = lambda x: F.char_length(x).cast("long")
    before = F.slice(gaps, F.lit(1), F.size(matches))
    starts = F.zip_with(_prefix_sums(F.zip_with(before, matches, lambda g, x: g + length(x))), before, lambda p, g: p + g)

    def counts(x: Column) -> Column:
        value = F.regexp_extract(x, pattern, group) if group else x
        mixed = x.rlike("[A-Z]") & x.rlike("[a-z]") & x.rlike("[0-9]") if kind == "opaque" else F.lit(True)
        return (F.char_length(value) >= least) & mixed

    found = F.zip_with(starts, matches, lambda s, x: F.when(counts(x), F.struct(s.alias("start"), F.lit(_KIND_NO[kind]).alias("kind_no"), (s + length(x)).alias("end"))))
    return F.filter(found, lambda s: s.isNotNull())


def find_parts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``base`` and ``weak``: sorted arrays of (start, kind_no, end) of all matches of either sort."""
    d = docs.select(*[col(c) for c in keep], col(text).alias("__t"))
    d = d.withColumns({f"__m_{k}": F.regexp_extract_all("__t", F.lit(KINDS[k][2]), F.lit(0)) for k in KINDS})
    d = d.withColumns({f"__g_{k}": F.when(F.size(f"__m_{k}") > 0, F.transform(F.split("__t", KINDS[k][2], -1), lambda x: F.char_length(x).cast("long"))) for k in KINDS})
    none = F.expr("cast(array() as array<struct<start: bigint, kind_no: int, end: bigint>>)")
    spans = {k: F.when(F.size(f"__g_{k}") > 0, _spans(k, F.col(f"__m_{k}"), F.col(f"__g_{k}"))).otherwise(none) for k in KINDS}
    sides = {"base": F.concat(*[spans[k] for k in BASE]), "weak": F.concat(*[spans[k] for k in KINDS if k not in BASE])}
    return d.select(*[col(c) for c in keep], *[F.coalesce(F.sort_array(x), none).alias(c) for c, x in sides.items()])


def _linked(found: DataFrame, reach: int) -> DataFrame:
    """(__row, linked): the weak parts that complementary parts make reportable, by document."""
    role = F.element_at(F.array(*[F.lit(r) for r, *_ in KINDS.values()]), F.col("kind_no") + 1)
    parts = found.select("__row", F.inline(F.concat("base", "weak"))).withColumns(
        {"role": role, "alone": F.col("kind_no") < len(BASE), "cell": F.expr(f"start div {reach}")})
    cells = parts.groupBy("__row", "cell").agg(F.collect_list(F.struct("start", "end", "role", "alone")).alias("near"))  # at most `reach` a kind
    weak = parts.filter("not alone").select("__row", "start", "kind_no", "end", "role", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    met = weak.join(cells, ["__row", "cell"])
    others = F.filter("near", lambda x: F.abs(x["start"] - F.col("start")) <= reach)
    foreign = F.filter(others, lambda x: x["role"] != F.col("role"))
    met = met.select("__row", "start", "kind_no", "end", F.exists(foreign, lambda x: x["alone"]).alias("strong"), F.transform(foreign, lambda x: x["role"]).alias("roles"),
                     F.exists(others, lambda x: x["alone"] & (x["role"] == F.col("role")) & (x["start"] < F.col("end")) & (x["end"] > F.col("start"))).alias("part"))
    flags = met.groupBy("__row", "start", "kind_no", "end").agg(F.bool_or("strong").alias("strong"), F.bool_or("part").alias("part"),
                                                               F.size(F.array_distinct(F.flatten(F.collect_list("roles")))).alias("roles"))  # three rows
    told = flags.filter("not part and (strong or roles = 2)")
    return told.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "end"))).alias("linked"))


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(spans, lambda s: F.struct(F.element_at(kinds, s["kind_no"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def scan_secrets(docs: DataFrame, text: str = "text", *, reach: int = REACH, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``base``, ``linked`` and ``secrets``, arrays of (kind, start, end) by start
    and then in the order of ``KINDS``: matches of the base kinds, weak parts that are linked, and both.

    Starts and ends count code points, ends exclusive.  Matches of a kind are leftmost and don't overlap; those of
    different kinds may.  A weak part of the role of a base match that it overlaps belongs to that match and isn't reported again.

    Null and empty texts have no parts.  Repeated rows get equal results.  Texts are read whole, however long.  Columns of
    ``docs`` named like a new one are replaced.  An empty table gives an empty result.
    """
    new = ["base", "linked", "secrets"]
    names = [c for c in without(docs, [*new, "weak", "__row"]) if carry is None or c in carry]
    d = docs.select(*[col(c).alias(f"__keep{i}") for i, c in enumerate(names)], F.coalesce(col(text).cast("string"), F.lit("")).alias("__text"))
    kept = [f"__keep{i}" for i in range(len(names))]
    found = written(find_parts(d, "__text", kept).withColumn("__row", F.monotonically_increasing_id()))
    none = F.expr("cast(array() as array<struct<start: bigint, kind_no: int, end: bigint>>)")
    some = found.filter("size(weak) > 0")
    some = some.join(_linked(some, reach), "__row", "left").select(*kept, "base", F.coalesce("linked", none).alias("linked"))
    out = some.unionByName(found.filter("size(weak) = 0").select(*kept, "base", none.alias("linked")))
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, names, strict=True)], _named(F.col("base")).alias("base"), _named(F.col("linked")).alias("linked"),
                      _named(F.sort_array(F.concat("base", "linked"))).alias("secrets"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
