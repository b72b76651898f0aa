"""The corpus pipeline: each stage on its own input, and the whole run against a brute-force version."""

import random

import duckdb
import pytest

import corpus_pipeline as cp
from tests.llm.test_dedup import brute
from tillcast.llm import decontaminate, source_mix

SF = "/root/testdata/sf0.001"


def test_whole_run_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    first = {i for i, _, component in brute([(r.doc_id, r.text) for r in rows], 5, 80) if i == component}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [[r.doc_id, r.source, r.text] for r in rows if r.doc_id in first])
    leaks = {r[0] for r in con.execute(decontaminate.contaminations_sql()).fetchall()}
    con.execute(f"DELETE FROM documents WHERE doc_id IN ({', '.join(map(str, leaks)) or 'NULL'})")
    expected = sorted(con.execute(source_mix.mix_sql()).fetchall())
    assert sorted(tuple(r) for r in cp.run(spark, SF).collect()) == expected


DDL = "doc_id long, text string, lang string, source string, n_chars long, component_id string, shared int, said string"


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontaminate"])
def test_stages_keep_columns_and_clean_rows(spark, name):
    step = dict(cp.STAGES)[name]
    clean = "the quick brown fox number one jumps over the lazy dog in the old garden"
    text = "ein hund und eine katze gehen heute in den garten hinter dem haus und bleiben"
    rows = [(i, f"{clean} {chr(97 + i) * 9}", "en", None, 1, "x", 2, "y") for i in range(8)]
    rows += [(20 + i, f"{text} {chr(97 + i) * 9}", "de", "b", None, None, 2, "y") for i in range(8)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows += [(40, item, "en", "b", 1, "x", 2, "y"), (None, "a text that nothing else is like at all", None, "b", 1, None, None, None)]
    rows += [(41, None, "en", "b", 1, "x", 2, "y"), (42, "", "en", "b", 1, "x", 2, "y"), (43, "1 2 3", "en", "b", 1, "x", 2, "y")] * 2
    df = spark.createDataFrame(rows, DDL)
    got = step(spark, df, SF)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    kept = sorted((tuple(r) for r in got.collect()), key=str)
    if name == "language":
        wanted = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    elif name == "decontaminate":
        wanted = [r for r in rows if r[0] != 40]
    else:
        near = {r[0] for r in brute([(r[0], r[1]) for r in rows], 5, 80) if r[1] and r[0] == r[2]}
        wanted = [r for r in rows if not r[1] or r[0] is None or r[0] in near and r[0] < 41] + [r for r in rows[-6:] if r[0] == 43][:1]
        wanted = [r for r in wanted if r[0] != 43] + [r for r in rows if r[0] == 43][:1]
    assert kept == sorted(wanted, key=str)


def test_language_stage_drops_noise_and_languages_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = random.Random(4)
    noise = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(400)) for _ in range(20)]
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı",
    ]
    plain = ["the of", "Re.", "and", "The the this to be der die und das le la les des el la los con", "to the thing that is on of and"]
    made = [(10**6 + i, t, None, "x", len(t)) for i, t in enumerate([*noise, *foreign, *plain])]
    rows = docs.unionByName(spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in cp.languages(spark, rows, "").select("doc_id").collect()}
    with_letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert kept & {r[0] for r in made} == {r[0] for r in made[-len(plain) :]}
    assert kept - {r[0] for r in made} == with_letters


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in cp.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "mix"]
