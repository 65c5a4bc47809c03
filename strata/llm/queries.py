"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, divergence, html, langid, licenses, manifest, mixing, neardup, quality, ranking, secrets, sharding, tokens
from strata.llm.common import col, held_out, table, written


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out().alias("held_out"), "text")
    found = written(quality.quality_features(docs, carry=["doc_id", "held_out"]))
    model = quality.fit_quality(found.filter("not held_out"), table(spark, sf_dir, "labels"))
    return quality.score_quality(found, model)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = written(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("n_tokens")))
    return mixing.mix_sources(docs, mixing.mixing_plan(docs, "doc_id", "source", "n_tokens"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_language(docs.filter(~held_out()))
    found = langid.detect_language(docs.select("doc_id", held_out().alias("held_out"), "text"), model, carry=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # the vocabulary files of this machine

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_links")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", "n_matches", "licenses", "match_ids", "match_starts")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = [F.size(F.array_compact(F.transform("base.kind", lambda x: F.when(x == k, x)))).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves, _ = manifest.merkle_manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                                         tampered={"text": manifest.lowered(col("text"))}, where=manifest.chosen(col("doc_id")))
    return leaves.select(col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_mix_sources, op4_language, op5_token_counts, op6_quality_rules,
                                   op7_near_duplicates, op8_main_text, op9_shard, op10_licenses, op11_secrets,
                                   op12_merkle, op13_search)}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


def _secrets_sql(reach: int = secrets.REACH) -> str:
    """Each kind's matches by what stands between them; weak parts joined with all parts of their text."""
    kinds = []
    for no, (kind, (role, base, pattern, group, least)) in enumerate(secrets.KINDS.items()):
        p = "'" + pattern.replace("'", "''") + "'"
        value = f"regexp_extract(m[i], {p}, {group})"
        mixed = " AND regexp_matches(m[i], '[A-Z]') AND regexp_matches(m[i], '[a-z]') AND regexp_matches(m[i], '[0-9]')" if kind == "opaque" else ""
        kinds.append(f"""
            SELECT r, doc_id, {no} AS no, '{kind}' AS kind, '{role}' AS role, {base} AS base, s AS a, s + length(m[i]) AS z FROM (
                SELECT *, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s FROM (
                    SELECT r, doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
                        SELECT r, doc_id, regexp_extract_all(t, {p}) AS m, regexp_split_to_array(t, {p}) AS g FROM d))) WHERE length({value}) >= {least}{mixed}""")
    listed = "coalesce(string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(z AS BIGINT), ',' ORDER BY a, no) FILTER (WHERE {0}), '')"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in secrets.BASE)
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        p AS ({" UNION ALL ".join(kinds)}),
        w AS (SELECT x.r, x.no, x.a FROM p x JOIN p y ON x.r = y.r AND abs(x.a - y.a) <= {reach} WHERE NOT x.base GROUP BY x.r, x.no, x.a, x.z, x.role
              HAVING NOT bool_or(y.base AND y.role = x.role AND y.a < x.z AND y.z > x.a)
                 AND (bool_or(y.base AND y.role <> x.role) OR count(DISTINCT y.role) FILTER (WHERE y.role <> x.role) = 2)),
        told AS (SELECT p.* FROM p LEFT JOIN w USING (r, no, a) WHERE p.base OR w.r IS NOT NULL)
        SELECT d.doc_id, {counts}, sha256({listed.format('base')}) AS base_sha256, {listed.format('kind IS NOT NULL')} AS spans
        FROM d LEFT JOIN told USING (r) GROUP BY d.r, d.doc_id"""


def _merkle_sql(levels: int = 7, top_levels: int = 3) -> str:
    """The manifest for up to 8 ** levels rows a language and 8 ** top_levels languages, level by level."""
    def value(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    parts = [f"""
        RECURSIVE tbl AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
        d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(
            string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0
            THEN {leaf(_LOWER.format('text'))} ELSE {leaf('text')} END AS other FROM documents, tbl),
        p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
        l0 AS (SELECT lang, pos AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM p)"""]

    def tree(name: str, key: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""
        {name}r{k} AS (SELECT {key} AS key, i // 8 AS i, list(h ORDER BY i) AS run FROM {name}{k} WHERE n > 1 GROUP BY ALL),
        {name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM (SELECT key AS {key}, i, sha256(array_to_string(run, '')) AS h FROM {name}r{k}
            UNION ALL SELECT {key}, i, h FROM {name}{k} WHERE n = 1))""")

    tree("l", "lang", levels)
    parts.append(f"""
        g0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n, lang FROM l{levels})""")
    tree("g", "g", top_levels)
    steps = []
    joins = f"JOIN g0 ON g0.lang IS NOT DISTINCT FROM p.lang JOIN g{top_levels} z ON true"
    for k in range(levels):
        joins += f" LEFT JOIN lr{k} ON lr{k}.key IS NOT DISTINCT FROM p.lang AND lr{k}.i = p.pos // {8 ** (k + 1)}"
        steps.append((f"lr{k}.run", f"p.pos // {8 ** k} % 8"))
    for k in range(top_levels):
        joins += f" LEFT JOIN gr{k} ON gr{k}.i = g0.i // {8 ** (k + 1)}"
        steps.append((f"gr{k}.run", f"g0.i // {8 ** k} % 8"))
    runs = ", ".join(f"{{'run': {run}, 'own': {own} + 1}}" for run, own in steps)
    parts.append(f"""
        f0 AS (SELECT p.doc_id, p.leaf, p.other, g0.h AS subroot, z.h AS root, list_filter([{runs}], lambda s: s.run IS NOT NULL) AS path FROM p {joins})""")
    fold = "list_reduce(list_prepend({'run': [other], 'own': 0}, path), lambda a, s: {'run': [sha256(array_to_string(list_transform(s.run, lambda x, j: CASE WHEN j = s.own THEN a.run[1] ELSE x END), ''))], 'own': 0}).run[1]"
    return "WITH" + ",".join(parts) + f""",
        f1 AS (SELECT *, sha256(array_to_string(flatten(list_transform(path, lambda s: list_filter(s.run, lambda x, j: j <> s.own))), '')) AS proof_sha256, {fold} AS folded_root FROM f0)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f1"""


ORACLES = {
    "op11_secrets": _secrets_sql(),
    "op12_merkle": _merkle_sql(),
    "op2_decontaminate": f"""
        WITH b AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
        bi AS (SELECT id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS g FROM bi),
        d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
        di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw)),
        hit AS (SELECT doc_id, i, n, id FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM di) JOIN bw USING (n, g)),
        spans AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM hit GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_search": f"""
        WITH dt AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
        d AS (SELECT r, doc_id, len(w) AS n, w FROM dt WHERE len(w) > 0),
        c AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
        tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
        wt AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t),
        q AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS t FROM benchmark),
        s AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
              FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN (SELECT r, n FROM d) USING (r), c GROUP BY item_id, r)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 10""",
}
