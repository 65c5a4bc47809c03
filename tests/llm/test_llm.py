"""The training-data operators against brute force, on edge cases and on held-out rows."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontamination, divergence, html, langid, licenses, mixing, neardup, quality, queries, sharding, tokens

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, kept string, shard string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, seed):
    return " ".join(WORDS[(i * i * 7 + i * seed + seed * seed) % len(WORDS)] + str((i * seed) % 97) for i in range(n))


def edge_rows():
    """Nulls in all columns, empty and long texts, repeated rows and ids, clashing column names."""
    near = prose(300, 3).split()
    texts = [None, "", "   \n\t ", "one", "ÉCOLE été — 12", prose(20_000, 5), prose(300, 3), prose(300, 3), " ".join(near[:290] + ["x"] * 4), "!!! ### | | ***\n" * 40,
             "same line\nsame line\n" + prose(60, 9), prose(80, 11), prose(80, 11) + " " + prose(80, 13)]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "a", "b", None)[i % 4], 1, "w", "s", "k", "h") for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], rows[0], (None, "null id text", None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def near_sets(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def contamination(docs, items, size=10):
    windows = [(i, tuple(w[k:k + size])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - size + 1))]
    out = []
    for t in docs:
        w, hit, ids = words(t), set(), set()
        for i, g in windows:
            for k in range(len(w) - len(g) + 1):
                if w[k] == g[0] and tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    ids.add(str(i)) if i is not None else None
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, edge, block_bytes):
    items = [(1, prose(80, 11)), (10, "ONE"), (2, None), (3, ""), (None, prose(14, 13)), (1, prose(80, 11)), (7, "no such words here at all today my dear friend and so on")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(edge, bench, block_bytes=block_bytes).select("text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert [tuple(r)[1:] for r in got] == contamination([r["text"] for r in got], items)
    assert sum(r["contaminated"] for r in got) >= 3
    assert decontamination.decontaminate(edge, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0
    assert decontamination.decontaminate(edge.limit(0), bench).count() == 0


def test_rules_base_counts(spark, edge):
    got = divergence.quality_rules(edge).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        t = r["text"] or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert divergence.quality_rules(edge.limit(0)).count() == 0


def test_rules_keep_clean_documents(spark):
    q = divergence.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("not base_failed")
    n = {(r["quality"], r["kept"]): r["n"] for r in q.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert n.get((1, False), 0) <= 0.005 * n[1, True] and n.get((0, True), 0) <= 0.2 * n[0, False]  # short tables of clean words are near the bound


def test_near_duplicates_equal_brute_force(spark, edge):
    for docs in (edge, spark.read.parquet(f"{SF}/documents.parquet")):
        got = neardup.near_duplicates(docs, carry=["doc_id", "text"]).collect()
        assert len(got) == docs.count()
        sets, root = {r["text"] or "": near_sets(r["text"]) for r in got}, {}
        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        by = {}
        for t, s in sets.items():
            for g in s:
                by.setdefault(g, []).append(t)
        for a, b in {(a, b) for ts in by.values() for a in ts for b in ts if a < b}:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
        mine, truth = {}, {}
        for r in got:
            mine.setdefault(r["class_key"], set()).add(r["text"] or "")
            truth.setdefault(top(r["text"] or ""), set()).add(r["text"] or "")
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, truth.values()))
        one = neardup.one_of_each(docs)
        assert one.columns == docs.columns and one.count() == len(truth)
    assert neardup.near_duplicates(edge.limit(0)).count() == 0 and neardup.one_of_each(edge.limit(0)).count() == 0


def test_large_group_of_near_copies(spark):
    base = prose(200, 3).split()
    rows = [(i, " ".join(base[:i % 150 + 20] + [f"q{i}"] + base[i % 150 + 21:])) for i in range(400)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("class_id").distinct().count() == 1 and got.filter("class_size = 400").count() == 400


def variants_of_one(spark, sizes, groups):
    """An original of 400 shingles and, at each of ``groups`` places, texts with a run of ``sizes`` words replaced there, which share three new words; other
    texts, so that no shingle is common; and the components of what has a Jaccard similarity of 0.8 or more (brute force)."""
    base = [f"w{i}" for i in range(404)]
    texts = [" ".join(base)]
    for g in range(groups):
        at = 4 + g * 340 // groups
        texts += [" ".join(base[:at] + [f"n{g}x{i}" if i < 3 else f"n{g}y{i}v{v}" for i in range(m)] + base[at + m:]) for v, m in enumerate(sizes)]
    sets, root = [near_sets(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    rows = list(enumerate(texts)) + [(10_000 + i, " ".join(f"f{i}z{j}" for j in range(12))) for i in range(11 * len(texts))]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), root


def classes_of(docs, n, **options):
    got = {r["doc_id"]: r["class_key"] for r in neardup.near_duplicates(docs, **options).collect()}
    return [got[i] for i in range(n)]


def missed(root, found):
    """How many texts lie in another class than the first text of their component does, and whether texts of two components share a class."""
    return sum(found[i] != found[root.index(r)] for i, r in enumerate(root)), len(set(zip(root, found, strict=True))) > len(set(found))


def test_pairs_alike_but_unlike_their_hub(spark):
    docs, root = variants_of_one(spark, (43, 43), 100)  # 0.79 from the original, 0.802 from each other
    assert len(set(root)) == 101
    assert missed(root, classes_of(docs, len(root), bands=8, rows=1)) == (0, False)


def test_pairs_of_which_one_matches_the_hub(spark):
    docs, root = variants_of_one(spark, (38, 43), 100)  # 0.81 and 0.79 from the original, 0.8 or more from each other
    assert len(set(root)) == 1
    assert missed(root, classes_of(docs, len(root), bands=8, rows=1)) == (0, False)


def test_a_third_of_the_rows_are_near_copies(spark):
    base = [f"w{i}" for i in range(404)]
    near, n = [], 0
    for g in range(60):  # 0.82 to 0.86 from the original, each by a run of words at another place
        m, at = 26 + g % 10, 4 + g * 6
        near.append(" ".join(base[:at] + [f"n{g}y{i}" for i in range(m)] + base[at + m:]))
        n += 0.82 <= len(near_sets(near[-1]) & near_sets(" ".join(base))) / len(near_sets(near[-1]) | near_sets(" ".join(base))) <= 0.865
    assert n == 60
    rows = list(enumerate([*near, *[" ".join(base)] * 40])) + [(10_000 + i, " ".join(f"f{i}z{j}" for j in range(12))) for i in range(200)]
    found = classes_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 100)
    assert len(set(found)) == 1


def test_mixing_meets_budget_and_limit(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", 50 + i % 40) for i in range(3000)] + [(None, None, None), (5, "zero", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long").repartition(4)
    plan = mixing.mixing_plan(docs, "doc_id", "source", "n", block_tokens=5000, min_entropy=0.99, max_repeats=2.0)
    p = {r["source"]: r for r in plan.collect()}
    total = sum(r[2] or 0 for r in rows)
    weighed = {s: r for s, r in p.items() if r["tokens"]}
    assert abs(sum(r["weight"] for r in weighed.values()) - 1) < 1e-9 and max(r["repeats"] for r in weighed.values()) <= 2 + 1e-5
    got = mixing.mix_sources(docs, plan)
    spent = {r["source"]: r["t"] for r in got.groupBy("source").agg(F.sum("n").alias("t")).collect()}
    for s, r in weighed.items():
        assert r["weight"] * total - 200 <= spent[s] <= r["weight"] * total + 1
    assert got.filter("source is null").count() == 1 and got.filter("source = 'zero'").count() == 1
    assert got.groupBy("doc_id", "source").agg(F.max("epoch").alias("e"), F.count("*").alias("c")).filter("e <> c").count() == 0
    empty = docs.limit(0)
    assert mixing.mix_sources(empty, mixing.mixing_plan(empty, "doc_id", "source", "n")).count() == 0


def test_shards_are_near_equal(spark, edge):
    rows = [(i // 2 if i % 3 else 7, "x" * (i % 900)) for i in range(4000)] + [(1, "same")] * 3000 + [(None, None), (None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard(docs, n_shards=8).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len(t or "") + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    size, slots = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(size) == 8 and max(size.values()) - min(size.values()) <= 2 * 916
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(edge).count() == len(edge_rows()) and sharding.shard(edge.limit(0)).count() == 0


def test_token_counts_equal_the_library(spark, edge):
    P, T = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    path = P.path("word_bpe_49k.json")
    lib = T.Tokenizer.from_file(path)
    odd = ["don't I'LL we'Ve", "a<|endoftext|>b <|startoftext|><|endoftext|", "ΑΣ ΟΔΟΣ İstanbul ǅ", "ﬁ ½ ² ٣", "日本語 한국어", "a\x1cb\x85c　d᠎e", "é é", "a" * 3000, "Ⅷ ⓐ 𝔸"]
    docs = edge.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd)], "doc_id long, text string, lang string"))
    for r in tokens.count_tokens(docs, path, limit=100).collect():
        n = len(lib.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 100), r["text"]


def test_main_text(spark):
    p = "This is a paragraph of the article, and it is long enough to be a text of its own. " * 2
    page = f"""<html><head><title>t</title><script>var a="</p>";</script></head><body><header><a href="/">Home</a> Site</header><nav><ul><li><a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies. Accept all of them now please.</div><main><article><h1>Head &amp; line</h1><p>{p}<b>bold<p>Short.
 two</p><div class="ad">Buy this now</div><p>Last &copy; one.</p></article><div id="comments"><p>{p} first!</p></div></main><aside>{p}</aside><form>Mail <input></form><footer>{p}</footer>"""
    want = "\n".join(["Head & line", re.sub(r"\s+", " ", p).strip() + " bold", "Short. two", "Last © one."])
    rows = [(1, page), (2, None), (3, ""), (4, "<p>Only"), (5, "<nav>x</nav>"), (6, "<article><p>a</p><!-- cut")]
    got = {r["page_id"]: r for r in html.extract_main_text(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old"))).collect()}
    assert got[1]["text"] == want.replace(". bold", ". bold")
    assert [got[i]["text"] for i in (2, 3, 4, 5, 6)] == ["", "", "Only", "", "a"] and got[1]["n_chars"] == len(want)


def test_license_notices_are_found(spark, edge):
    texts = [name_text[1] for name_text in licenses.TEMPLATES]
    rows = [(i, f"{prose(50 + i, 3)}.\n{t}\n{prose(40, 5)}") for i, t in enumerate(texts)] + [(99, None), (100, prose(500, 7))]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        assert name in got[i]["licenses"].split(","), (name, got[i]["licenses"])
    assert got[99]["n_matches"] == got[100]["n_matches"] == 0
    assert licenses.scan_licenses(edge).count() == len(edge_rows())


def test_licenses_equal_brute_force(spark):
    def grams(t):
        w = words(t)
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    notices = {"All rights reserved.": "proprietary", "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
               "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0"}
    for before in range(4):  # at every place of a stride
        rows = [(i, " ".join(["so"] * before + [t])) for i, t in enumerate(notices)]
        got = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == dict(enumerate(notices.values()))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").filter("doc_id % 4 = 0")
    templates = [(n, grams(t)) for n, t in licenses.TEMPLATES]
    some = 0
    for r in licenses.scan_licenses(docs, carry=["doc_id", "text"]).collect():
        have = grams(r["text"])
        want = {n for n, g in templates if len(g & have) >= 0.8 * len(g)}
        assert set(filter(None, r["licenses"].split(","))) <= want and bool(want) == bool(r["licenses"])
        some += bool(want)
    assert some > 0


def test_quality_and_language_on_held_out_rows(spark):
    labels, docs = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    q = queries.op1_quality(spark, SF).filter("held_out").join(labels, "doc_id")
    assert q.filter("predicted = quality").count() >= 0.95 * q.count()
    lang = queries.op4_language(spark, SF).filter("held_out").join(docs, "doc_id")
    assert lang.filter("lang = lang_pred").count() >= 0.99 * lang.count()


def test_quality_and_language_edge_cases(spark, edge):
    found = quality.quality_features(edge)
    for model in (quality.fit_quality(found, spark.createDataFrame([], "doc_id long, quality int")),
                  quality.fit_quality(found, spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None)], "doc_id long, quality int"))):
        got = quality.score_quality(found, model).collect()
        assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    model = langid.fit_language(edge)
    got = {r["doc_id"]: r for r in langid.detect_language(edge, model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 9)] == ["und"] * 4 and got[5]["lang_pred"] in ("en", "fr")
    none = langid.fit_language(edge.limit(0))
    assert langid.detect_language(edge, none).filter("lang_pred <> 'und'").count() == 0


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang in ('en', 'de')")
    model = langid.fit_language(docs)
    en, de = (docs.filter(f"lang = '{x}' and n_chars between 1500 and 3000").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    r = langid.detect_language(spark.createDataFrame([(1, f"{en} {de}")], "doc_id long, text string"), model).first()
    assert r["span_langs"][0] == "en" and r["span_langs"][-1] == "de" and sum(r["span_words"]) == len(words(f"{en} {de}"))


def test_pipeline_stages(spark, edge):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF)
            assert name == "shard" or out.columns == docs.columns
            assert out.count() <= 4 * rows.count()
    out = corpus_pipeline.run(spark, SF)
    assert out.select("doc_id").distinct().count() > 500 and out.filter("shard not between 0 and 39").count() == 0
