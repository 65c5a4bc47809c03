"""Quality rules by distribution divergence, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated three-word windows
of a text.  The verdict compares two histograms of the text, of character
classes and of its language's common words, with the histograms of all
documents of that language by the Jensen-Shannon distance (base 2, 0 to 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, without, written

# Common words by language, most frequent first.
COMMON_WORDS = {
    "en": "the of and to in is for that on with as by it be are this was from or at",
    "fr": "de la le et les des en un une du que est pour qui dans par sur pas au avec",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "es": "de la que el en y a los del se las por un para con no una su al es",
    "it": "di e il la che in a per un è del una con non le si da i dei al",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as",
    "nl": "de van het een en in is dat op te zijn met voor die niet aan er om ook als",
}
#: Character classes in the order of the histogram (common ones first), each with the letter that stands for it while counting.
CLASSES = {
    "consonant": ("c", "bcdfghjklmnpqrstvwxyz"),
    "vowel": ("v", "aeiou"),
    "space": (" ", " \t\x0b\x0c\r"),
    "upper": ("U", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": ("0", "0123456789"),
    "newline": ("\n", "\n"),
    "symbol": ("#", "#*$%&|<>"),
    "punctuation": (".", "!\"'()+,-./:;=?@[\\]^_`{}~"),
}
RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "char_distance", "word_distance", "kept"]
#: A language with a smaller share of the documents is compared with all documents; so there are at most 1001 references.
MIN_SHARE = 0.001
#: Letters that stand for a text's words while they are counted: one for each rank of a common word, and one for the others.
_LETTERS = "abcdefghijklmnopqrst"


def _counted(df: DataFrame, mapped: str, letters: list[str], name: str) -> DataFrame:
    """``df`` with array ``name``: how often each of ``letters`` stands in ``mapped``.

    Each is taken out before the next is counted, so that the string gets shorter; the most frequent come first.
    """
    counts = []
    for i, letter in enumerate(letters):
        rest = f"{mapped}{i}"
        df = df.withColumn(rest, F.replace(F.col(mapped if not i else f"{mapped}{i - 1}"), F.lit(letter), F.lit("")))
        counts.append(F.octet_length(mapped if not i else f"{mapped}{i - 1}") - F.octet_length(rest))
    return df.withColumn(name, F.array(*counts)).drop(*[f"{mapped}{i}" for i in range(len(letters))])


def _key(lang: str) -> Column:
    return F.coalesce(F.lower(col(lang).cast("string")), F.lit(""))


def _profile(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``docs`` with __words, __chars (class counts and the rest) and __common (counts of common words and the rest)."""
    lists = docs.sparkSession.range(1).select(F.explode(F.create_map(*[
        x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v.split()]))
    ])).alias("__list_lang", "__list"))
    source, target = "".join(c for _, c in CLASSES.values()), "".join(a * len(c) for a, c in CLASSES.values())
    letters = F.array(F.lit("-"), *[F.lit(c) for c in _LETTERS])
    d = docs.withColumn("__key", _key(lang)).withColumn("__t", F.coalesce(col(text).cast("string"), F.lit("")))
    d = d.join(F.broadcast(lists), F.col("__key") == F.col("__list_lang"), "left").drop("__list_lang")  # a row a language of the fixed list
    d = d.withColumn("__mapped", F.translate("__t", source, target))
    d = d.withColumn("__words", F.filter(F.split("__t", "[\\x20\\x09-\\x0D]+"), lambda w: w != F.lit("")))
    longest = max(len(w.encode()) for v in COMMON_WORDS.values() for w in v.split())
    every = sorted({w for v in COMMON_WORDS.values() for w in v.split()})
    short = F.transform(F.filter("__words", lambda w: F.octet_length(w) <= longest), F.lower)
    d = d.withColumn("__ranks", F.array_join(F.transform(F.filter(short, lambda w: w.isin(every)), lambda w: F.element_at(
        letters, (F.coalesce(F.array_position("__list", w), F.lit(0)) + 1).cast("int"))), ""))
    d = _counted(d, "__mapped", [a for a, _ in CLASSES.values()], "__known")
    d = _counted(d, "__ranks", list(_LETTERS), "__hits")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    return d.withColumns({"__chars": F.concat("__known", F.array(F.length("__t") - total("__known"))),
                          "__common": F.concat("__hits", F.array(F.size("__words") - total("__hits")))})


def references(found: DataFrame) -> DataFrame:
    """The reference histograms of each language of ``features``: ``ref_lang``, ``ref_chars`` and ``ref_common``, shares.

    All documents with a word count.  A character class has the median of its shares (so that a tenth of broken
    documents doesn't move it), a common word its share of all words.  One row has ``ref_lang`` null and holds all
    documents; a language with a share of them below ``MIN_SHARE`` has no row.  So there are at most
    1 / MIN_SHARE + 1 rows.
    """
    n, m = len(CLASSES) + 1, len(_LETTERS) + 1
    rows = found.filter("n_words > 0").select(
        F.explode(F.array(F.col("__key"), F.lit(None).cast("string"))).alias("k"), "__chars", "__common")
    part = rows.groupBy("k").agg(
        F.count("*").alias("docs"),
        *[F.percentile_approx(F.col("__chars")[i] / F.greatest(_total(F.col("__chars")), F.lit(1)), 0.5, 1000).alias(f"c{i}")
          for i in range(n)],
        *[F.sum(F.col("__common")[i].cast("long")).alias(f"w{i}") for i in range(m)])
    table = written(part.select("k", "docs", F.array(*[f"c{i}" for i in range(n)]).alias("c"),
                                F.array(*[f"w{i}" for i in range(m)]).alias("w")))
    total = (table.filter("k is null").select("docs").first() or [0])[0]
    return table.filter(F.col("k").isNull() | (F.col("docs") >= MIN_SHARE * total)).select(
        F.col("k").alias("ref_lang"), _shares(F.col("c")).alias("ref_chars"), _shares(F.col("w")).alias("ref_common"))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def _shares(counts: Column) -> Column:
    total = _total(counts)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def _repeat_words(words: str) -> tuple[dict, Column]:
    """Columns to add first, and the count of words inside three-word windows that stand in the text twice or more.

    A text whose windows all differ has none.  In others windows are sorted by hash and position packed into one long (so many
    low bits as positions need); equal neighbours are repeats; each repeat adds the words that the one before left uncovered.
    """
    n = F.size(words)
    bits = F.length(F.bin(n))
    windows = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    packed = F.transform("__windows", lambda h, i: F.call_function("shiftleft", h, F.col("__bits")).bitwiseOR(i.cast("long")))
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    same = lambda g, i: F.coalesce(
        F.call_function("shiftright", F.get("__sorted", i), F.col("__bits")) == F.call_function("shiftright", g, F.col("__bits")),
        F.lit(False))
    low = (F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bits")) - 1)
    found = F.sort_array(F.transform(F.filter("__sorted", lambda g, i: same(g, i - 1) | same(g, i + 1)),
                                     lambda g: g.bitwiseAND(F.col("__low"))))
    start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(found, start, lambda a, p: F.struct(
        p.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n")), lambda a: a["n"])
    return [{"__bits": bits, "__windows": windows}, {"__low": low, "__sorted": F.when(some, F.sort_array(packed)).otherwise(
        F.array().cast("array<bigint>"))}], covered


def features(docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the base counts and the two histograms of each text, in one pass."""
    kept = [c for c in without(docs, RULE_COLUMNS) if carry is None or c in carry]
    rows = docs.select(*[col(c).alias(f"__keep{i}") for i, c in enumerate(kept)],
                       col(text).alias("__text"), col(lang).alias("__lang"))
    d = _profile(rows, "__text", "__lang")
    steps, covered = _repeat_words("__words")
    for step in steps:
        d = d.withColumns(step)
    place = list(CLASSES).index
    space = F.col("__known")[place("space")] + F.col("__known")[place("newline")]
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.withColumns({
        "n_words": F.size("__words").cast("long"), "word_chars": (F.length("__t") - space).cast("long"),
        "n_symbols": F.col("__known")[place("symbol")].cast("long"), "__lines": lines,
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"), "__listed": F.col("__list").isNotNull()})
    d = d.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    return d.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(kept)], *RULE_COLUMNS[:5],
                    "__key", "__listed", "__chars", "__common")


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", *, min_words: int = 50, max_repeat_pct: int = 50,
                  max_char_distance: float = 0.2, char_slack: float = 2.0, max_word_distance: float = 0.29,
                  min_word_guard: int = 200, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``RULE_COLUMNS``; columns of those names in ``docs`` are replaced.

    A document is kept unless it has fewer than ``min_words`` words, more than ``max_repeat_pct`` percent of
    them in repeated windows, a character histogram farther than ``max_char_distance`` plus ``char_slack`` / words (short texts
    vary more) from its language's, or, from ``min_word_guard`` words on, a common-word histogram farther than ``max_word_distance``.

    A null or rare language is compared with all documents, and one without a list of common words by characters
    only (``word_distance`` is null).  A null text counts as empty: no words, not kept.  Repeated rows get equal
    results; an empty table gives an empty result.  Features are written once, so that every text is scanned once.
    """
    d = written(features(docs, text, lang, carry))
    kept = [c for c in d.columns if c not in RULE_COLUMNS and not c.startswith("__")]
    refs = references(d)
    every = refs.filter("ref_lang is null").select(F.col("ref_chars").alias("__all_chars"), F.col("ref_common").alias("__all_common"))
    d = d.join(F.broadcast(refs.filter("ref_lang <> ''")), F.col("__key") == F.col("ref_lang"), "left")  # at most 1 / MIN_SHARE rows
    d = d.join(F.broadcast(every), how="left")  # one row
    d = d.withColumns({
        "char_distance": _distance(_shares(F.col("__chars")), F.coalesce("ref_chars", "__all_chars")),
        "word_distance": F.when(F.col("__listed"), _distance(_shares(F.col("__common")), F.coalesce("ref_common", "__all_common"))),
        "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))})
    far = (F.col("char_distance") > max_char_distance + char_slack / F.greatest(F.col("n_words"), F.lit(1))) | (
        (F.col("n_words") >= min_word_guard) & F.coalesce(F.col("word_distance") > max_word_distance, F.lit(False)))
    return d.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).select(*[col(c) for c in kept], *RULE_COLUMNS)
