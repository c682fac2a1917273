import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordforge.llm import language, mixing, simhash

import corpus_pipeline as cp

WORDS = {"aa": ["bado", "kilum", "paba", "doki", "lumpa"], "bb": ["schung", "verich", "ungver", "ichsch", "ver"]}


def corpus():
    rng = random.Random(7)
    make = lambda lang, n: " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(n))
    rows = []
    for i in range(120):
        lang = rng.choice(["aa", "bb"])
        rows.append((i, make(lang, rng.randrange(20, 200)), lang, f"s{i % 4}"))
    long = make("aa", 900)
    rows += [(200, rows[0][1], rows[0][2], "s0"), (201, long, "aa", "s1"), (202, long + " end", None, "s2"), (203, long, None, None)]
    rows += [(210, "mail x.y@mail.example.com or +49 30 1234567 " + make("bb", 60), "bb", "s1"), (220, "12 34", "aa", "s1"), (221, None, "aa", "s1"), (222, "", None, None)]
    rows += [(230, make("aa", 50), "aa", "s3")] * 2 + [(None, make("bb", 50), "bb", "s3"), (240, make("aa", 20_000), "aa", "s2")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    old, language.STEPS = language.STEPS, 120
    d = str(tmp_path_factory.mktemp("pipeline"))
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("clash"))
    df.repartition(3).write.parquet(f"{d}/documents.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in cp.STAGES:
        stage(spark, docs, d).write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        out.append(docs.collect())
    yield d, out
    language.STEPS = old


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


def test_language_stage_keeps_texts_with_letters(stages):
    _, (first, *_) = stages
    want = [r for r in corpus() if r[1] and any(map(str.isalpha, r[1]))]
    assert sorted(((r.doc_id, r.text) for r in first), key=key) == sorted(((r[0], r[1]) for r in want), key=key)
    truth = {r[0]: r[2] for r in want}
    assert all(r.lang == truth[r.doc_id] for r in first if truth[r.doc_id])


def test_near_duplicates_equal_brute_force(stages):
    _, (first, second, *_) = stages
    sets = [simhash.shingle_set(r.text, 5) for r in first]
    part = list(range(len(first)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if simhash.similar(sets[i], sets[j]):
                part[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(first):
        groups[find(i)].append((r.doc_id is None, r.doc_id or 0))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in second) == Counter(min(g) for g in groups.values())
    assert {200, 202, 203} & {r.doc_id for r in second} == set()


def test_personal_data_is_redacted_and_the_rest_untouched(stages):
    _, (_, second, third, *_) = stages
    before = {r.doc_id: r.text for r in second}
    for r in third:
        assert r.n_chars == len(r.text)
        if r.doc_id == 210:
            assert "[EMAIL]" in r.text and "[PHONE]" in r.text and "@" not in r.text
        else:
            assert r.text == before[r.doc_id]


def test_mix_equals_taken_words(spark, stages):
    d, (_, _, third, fourth, _) = stages
    taken, _ = mixing.mix(spark.read.parquet(f"{d}/personal_data"))
    want = Counter()
    for r in taken.collect():
        want[r.doc_id] += int(r.taken / r.size + 0.5) if r.size else 0
    assert Counter(r.doc_id for r in fourth) == +want
    text = {r.doc_id: r.text for r in third}
    assert all(r.text == text[r.doc_id] for r in fourth)


def test_repeated_rows_share_the_mix(spark):
    rows = [(1, "a b c d", "s", 1)] * 5 + [(2, "x y", None, 1), (None, "q " * 9, "s", 1), (3, "", "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    taken, _ = mixing.mix(df)
    want = sum(int(r.taken / r.size + 0.5) for r in taken.where("doc_id = 1").collect())
    assert mixing.mixed(df).where("doc_id = 1").count() == want
    assert mixing.mixed(df.limit(0)).count() == 0


def test_tokens_decode(stages):
    _, (*_, fourth, fifth) = stages
    assert len(fourth) == len(fifth) and all(r.round_trip and r.n_pieces == len(r.ids) > 0 for r in fifth)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
