"""Texts in which Java's and ICU's idea of white space, case, words and bounds is not the SQL engine's."""

import duckdb
import pytest

from recordforge.plans import registry

LONG = "Pilocarpine constricts the pupil and opens the angle of the anterior chamber{} in the eye"
#: vertical tab, dotted I, final sigma, folds of s and k, a letter after a bound, letters of new scripts
ODD = ["\x0b", "İ", "ΑΣ", "ſ", "K", "é", "ࡰ", "\U00010570", "\U00031350", "Ᲊ", "\U00010d50", "\x1c", "　"]


def texts():
    out = ["\x0b\nrest", "x\n\x0b", "\x0b\x0b", "\x0bAnswer: B\nrest", "Anſwer: B\nrest", "correcté", None, ""]
    for o in ODD:
        stem = LONG.format(o)
        out += [f"{stem}\n{stem}", f"{stem}\nmore words {stem.lower()} and {o} others go on for long, {o * 3}", f"which{o}\nwhich", f"a{o}\nb c d{o}e", f"a\nb{o}c d e f g"]
        out += [f"The correct answer{o} is\nx", f"Option{o}A: y\nz", f"{stem} which{o}\nLong: {stem} which{o} words {'and more of them ' * 20}"]
        # seven tokens here or there: the odd character joins two of them or does not
        out += [f"go {o.lower()} one two{o}three four five six", f"GO {o} one two{o}three four five six seven", f"{o}b{o}", f"k{o}", f"{o * 4}d".lower()]
    return out


@pytest.mark.parametrize("name", ["stem_contamination", "incomplete_records", "cross_search", "coherence_score"])
def test_odd_texts_equal_sql(spark, tmp_path, name):
    docs = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts())]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, len(docs), 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, t) for i, t, *_ in docs], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({registry.ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def test_a_head_keeps_the_blank_that_ends_it(spark, tmp_path):
    """Twelve characters of "lens of the eye" end in a blank: neither "lens of themes" nor a text that ends there holds them."""
    docs = [(0, "lens of themes"), (1, "all the lens of the"), (2, "Lens of  the eye"), (3, "a lens of the eye"), (4, "iris of them"), (5, "x iris of the eye"), (6, "iris of the eye")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, "no such text"), (6, "all the lens of the ")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = registry.QUERIES["cross_search"](spark, str(tmp_path)).collect()
    want = con.execute(registry.ORACLES["cross_search"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want) == [(6, 1), (100002, 2), (100006, 5)]
