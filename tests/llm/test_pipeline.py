import random

import duckdb
import plain
import pytest
import sentencepiece

import corpus_pipeline
from filigree.llm import jaccard_join, mixing, queries, sentencepiece_codec, suffix_dedup
from helpers import DOCS, documents
from test_jaccard import brute as brute_links
from test_mixing import brute as brute_mix
from test_suffix import brute as brute_repeats

TABLES = {
    "documents": DOCS,
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    names = [f"word{i}" for i in range(400)] + ["the", "of", "and", "to"] * 25
    passage = " ".join(rng.choice(names) for _ in range(70))
    rows = []
    for i in range(220):
        text = "\n".join(" ".join(rng.choice(names) for _ in range(rng.randrange(6, 16))).capitalize() + "." for _ in range(rng.randrange(4, 10)))
        if i % 9 == 0:
            text = f"{text}\n{passage}"
        if i % 11 == 0:
            text = "CLICK HERE!!! ### @@ " * 30
        if i % 7 == 3 and i > 20:
            text = rows[i - 20][1] + " again"
        rows.append((i, text, ["en", "fr"][i % 2], f"src{i % 5}", len(text)))
    path = str(tmp_path_factory.mktemp("tables"))
    data = {
        "documents": rows,
        "pages": [(i, "u", f"<nav><a>n</a></nav><article><p>{rows[i][1]}</article>" if i % 3 else "<p>plain</p>") for i in range(40)],
        "conversations": [(i // 3, i % 3, ["user", "assistant"][i % 2], rows[i][1] + ("<|im_end|>" if i % 5 == 0 else "")) for i in range(60)],
        "embeddings": [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(120)],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(data[name], schema).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, folder)
        done = [tuple(r) for r in df.collect()]
        out.append((docs, df.columns, done))
        docs = spark.createDataFrame(done, df.schema)
    return out


def test_all_but_the_last_return_documents(stages):
    for docs, columns, _ in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert stages[-1][1] == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_ids", "round_trip"]


def test_each_stage_equals_its_brute_force_version(spark, folder, stages):
    docs, _, done = stages[0]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()][:120]  # so many that the plain version trains in one batch
    table = docs.where(docs["doc_id"].isin([i for i, _ in rows]))
    want = {i for (i, _), s in zip(rows, plain.quality_scores([t for _, t in rows])) if s >= 0.3}
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, table, folder).collect()} == want and len(want) < len(rows)
    assert len(done) < docs.count() and {tuple(r) for r in done} <= {tuple(r) for r in docs.collect()}

    docs, _, done = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    gone = {i for i, c, _ in brute_links(rows, jaccard_join.N, jaccard_join.THRESHOLD) if i != c}
    assert {r[0] for r in done} == {i for i, _ in rows} - gone and gone

    docs, _, done = stages[2]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    spans = brute_repeats(rows, suffix_dedup.LENGTH)
    assert spans
    texts = {r[0]: r[1] for r in done}
    for i, t in rows:
        assert texts.get(i) == (suffix_dedup.cut_text(t, *spans[i][:2]) if i in spans else t)
    assert all(len(r[1]) == r[4] for r in done)

    docs, _, done = stages[3]
    want = brute_mix([tuple(r) for r in docs.collect()], mixing.WEIGHTS, (3, 4), 2, 17)
    assert {i: sum(r[0] == i for r in done) for i in {r[0] for r in done}} == want

    docs, _, done = stages[4]
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.DEFAULT_MODEL)
    assert sorted(r[:5] for r in done) == sorted(tuple(r) for r in docs.collect())
    for r in done:
        assert r[5] == library.encode(r[1]) and r[6] == len(r[5]) and r[7] == (library.decode(r[5]) == r[1])


def test_stages_take_nulls_and_repeats(spark, folder):
    good = spark.read.parquet(f"{folder}/documents.parquet").limit(40).collect()
    rows = [tuple(r) for r in good] + [(None, good[0]["text"], "en", "src1", 5), (900, None, None, None, None), (901, "", "", "", 0), (902, "x " * 3000, None, "src1", 6000)]
    docs = spark.createDataFrame(rows + rows[:3], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[:5] == docs.columns
        out.collect()


def test_run_is_the_stages_in_turn(spark, folder, stages):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(r) for r in rows) == sorted(stages[-1][2])


def test_stages_take_empty_documents(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), folder).collect() == []


def test_queries_equal_their_sql(spark, folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, folder)
        columns = sorted(df.columns)
        cursor = con.execute(sql)
        place = {c[0]: i for i, c in enumerate(cursor.description)}
        assert sorted(place) == columns, name
        want = sorted(repr([r[place[c]] for c in columns]) for r in cursor.fetchall())
        assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == want, name


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
