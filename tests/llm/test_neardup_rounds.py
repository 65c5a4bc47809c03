"""Rounds of comparisons cost a bucket no more than its own rows; what they leave is settled."""

import inspect

from test_llm import missed, near_sets

from strata.llm import neardup


def test_no_round_makes_more_rows_than_the_buckets_have(spark, monkeypatch):
    base = [f"w{i}" for i in range(404)]
    texts = [" ".join(base)] + [" ".join(base[:4 + g] + [f"n{g}y{i}" for i in range(60)] + base[64 + g:]) for g in range(0, 320, 4)]
    # a cluster that is alike, yet unlike the original
    other = base[:100] + [f"o{i}" for i in range(60)] + base[160:]
    texts += [" ".join(other[:300 + g] + [f"p{g}"] + other[301 + g:]) for g in range(30)]
    sets, root = [near_sets(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    rows = list(enumerate(texts)) + [(10_000 + i, " ".join(f"f{i}z{j}" for j in range(12))) for i in range(11 * len(texts))]
    made, written = [], neardup.written

    def counted(df):
        out = written(df)
        if inspect.stack()[1].function == "_links":
            made.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(neardup, "written", counted)
    got = {r["doc_id"]: r["class_key"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    slots = made[0][1]
    assert made[0][0] == ["bucket", "node", "n"] and max(n for _, n in made) <= slots, made
    assert missed(root, [got[i] for i in range(len(texts))]) == (0, False)
    assert len(set(got.values())) > len(rows) - len(texts)
