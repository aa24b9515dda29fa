from helpers import documents
from tokenizers import Tokenizer

from metricforge.llm import queries, token_store


def test_documents_without_an_id_are_returned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 2)
    docs = documents(spark, dirty_ids=True).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = sorted(queries.QUERIES["op5_token_store"](spark, str(tmp_path)).collect(), key=lambda r: r["start"])
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in texts)
    library = Tokenizer.from_file(queries.TOKENIZER)
    sizes = lambda t: len(library.encode(t, add_special_tokens=False).ids) + 1
    none = [r for r in rows if r["doc_id"] is None]
    assert sorted(r["n_tokens"] for r in none) == sorted(sizes(t) for i, t in texts if i is None)
    # All spans together leave no gap.
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
