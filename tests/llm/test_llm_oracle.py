"""Queries of the training-data operators against SQL on the smallest tables, and what must hold of the others."""

import os
from collections import Counter

import duckdb
import pytest

from sieveline.llm import queries, tokenizer

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, db, name):
    got = queries.queries()[name](spark, SMALL)
    want = db.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_pieces_cover_their_texts(spark, db):
    texts = dict(db.execute("SELECT document_id, content FROM processed_documents WHERE content IS NOT NULL").fetchall())
    pieces: dict[str, list] = {}
    for r in queries.p4_pieces(spark, SMALL).collect():
        pieces.setdefault(r["document_id"], []).append(r)
    for key, own in pieces.items():
        own.sort(key=lambda r: r["piece_no"])
        assert all(r["n_words"] <= 500 and r["n_repeated"] <= 50 and texts[key][r["start_offset"] : r["end_offset"]] == r["piece_text"] for r in own)
        assert [w for r in own for w in r["piece_text"].split()[r["n_repeated"] :]] == texts[key].split()
    assert set(pieces) == {k for k, t in texts.items() if t.strip()}


@pytest.mark.skipif(not os.path.exists(tokenizer.vocabulary_path()), reason="no vocabulary")
def test_containers_are_full(spark):
    rows = queries.p8_containers(spark, SMALL).collect()
    ids = {r["doc_id"]: len(r["ids"]) for r in queries.p7_ids(spark, SMALL).collect()}
    filled, held = Counter(), Counter()
    for r in rows:
        filled[r["container_id"]] += r["n_tokens"]
        held[r["doc_id"]] += r["n_tokens"]
    assert max(filled.values()) <= 2048 and dict(held) == ids
    assert sum(filled.values()) / (2048 * (len(filled) - 1)) > 0.95  # a hundred texts; the last container is what is left
