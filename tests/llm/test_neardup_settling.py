"""The settling step compares few pairs of a large group of variants that share a passage, and misses none that are alike."""

import inspect

from test_llm import missed, near_sets

from strata.llm import neardup


def test_variants_with_a_common_passage_are_not_compared_pair_by_pair(spark, monkeypatch):
    base = [f"w{i}" for i in range(404)]
    common = [f"c{i}" for i in range(30)]
    # each with the common passage and a run of own words: below the threshold from the original and from each other
    texts = [" ".join(base)] + [" ".join(base[:4 + g] + [f"n{g}y{i}" for i in range(50)] + base[54 + g:] + common) for g in range(0, 320, 4)]
    # two that lie as far from the original and yet are alike
    texts += [" ".join([*base[:100], *[f"o{i}" for i in range(50)], *base[150:300], *[f"p{v}y{i}" for i in range(4)], *base[304:], *common]) for v in range(2)]
    sets, root = [near_sets(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    assert len(set(root)) > 50
    rows = list(enumerate(texts)) + [(10_000 + i, " ".join(f"f{i}z{j}" for j in range(12))) for i in range(11 * len(texts))]
    compared, written = [], neardup.written

    def counted(df):
        out = written(df)
        if inspect.stack()[1].function == "_links" and out.columns == ["node", "hub"]:
            compared.append(out.count())
        return out

    monkeypatch.setattr(neardup, "written", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_key"] for r in neardup.near_duplicates(docs, bands=8, rows=1).collect()}
    assert compared[-1] <= len(texts), compared  # the settling
    assert missed(root, [got[i] for i in range(len(texts))]) == (0, False)
