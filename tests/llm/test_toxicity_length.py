import random

from metricforge.llm import toxicity
from metricforge.sources.tables import load


def test_long_texts_of_clean_documents_stay_clean(spark):
    """Texts joined from held-out documents get the same verdict as their
    parts, at every length."""
    docs, labels = (load(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").where("text is not null").select("toxic", "text").collect()
    texts = {k: [r["text"] for r in sorted(rows) if r["toxic"] == k] for k in (0, 1)}
    rejected = lambda x: model.grades(x)[:, 0] < 0.5
    alike = {k: [t for t, bad in zip(x, rejected(x), strict=True) if bad == k] for k, x in texts.items()}
    print("caught", len(alike[1]), len(texts[1]), "clean", len(alike[0]), len(texts[0]))
    r = random.Random(0)
    for chars in (13_000, 52_000, 119_000, 243_000, 1_000_000):
        share = {}
        for kind in (0, 1):
            joined = []
            for _ in range(40):
                parts, size = [], 0
                while size < chars:
                    parts.append(r.choice(alike[kind]))
                    size += len(parts[-1])
                joined.append(" ".join(parts))
            share[kind] = rejected(joined).mean()
        print(chars, share)
        assert share[0] <= 0.01 and share[1] >= 0.95
