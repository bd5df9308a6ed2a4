"""Corpus queries beside their SQL, on the smallest tables with odd rows added."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidewright.llm import queries

SMALL = "/root/testdata/sf0.001"
PASSAGE = "the same passage of many bytes stands in this text and in another one, " * 4
ODD_TEXTS = [None, "", " \t\n", "one", "one two", "ONE two", "É é É é É é É é", "tick tock " * 40, "a b c " * 30 + "x " + "a b c " * 30,
             PASSAGE, "before " + PASSAGE + "after", "x" * 399 + "é", "x" * 250, "y" * 200, "lettere lettere lettere letere letere letere"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """A folder with the documents and embeddings of the smallest tables and odd rows behind them."""
    folder = tmp_path_factory.mktemp("odd")
    docs = pq.read_table(f"{SMALL}/documents.parquet")
    n = len(docs)
    more = {"doc_id": range(10 ** 6, 10 ** 6 + len(ODD_TEXTS)), "text": ODD_TEXTS, "lang": None, "source": None, "n_chars": None}
    rows = [{k: (list(v)[i] if v is not None else None) for k, v in more.items()} for i in range(len(ODD_TEXTS))]
    pq.write_table(pa.concat_tables([docs, pa.Table.from_pylist(rows, docs.schema)]), folder / "documents.parquet")
    vectors = pq.read_table(f"{SMALL}/embeddings.parquet")
    first = vectors.column("embedding")[0].as_py()
    strange = [None, [], [0.0] * len(first), [None, *first[1:]], [float("nan"), *first[1:]], [float("inf"), *first[1:]],
               first, [2 * x for x in first], [-x for x in first], first[:3], first[:3]]
    rows = [{"vec_id": 10 ** 6 + i, "embedding": v, "label": None} for i, v in enumerate(strange)]
    pq.write_table(pa.concat_tables([vectors, pa.Table.from_pylist(rows, vectors.schema)]), folder / "embeddings.parquet")
    assert n and len(vectors)
    return str(folder)


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op3_suffix_dedup", "op10_embedding_near_dups", "op11_spelling_variants",
                                  "op13_periodic_runs"])
def test_as_sql(spark, odd, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{odd}/{t}.parquet'")
    out = queries.QUERIES[name](spark, odd)
    got = sorted(map(tuple, out.collect()), key=repr)
    want = db.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert got == sorted(want, key=repr)
