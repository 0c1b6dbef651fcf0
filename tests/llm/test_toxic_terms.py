"""Terms of a small language, short words and aimed threats are learned whatever the number of other toxic rows."""

import numpy as np
from pyspark.sql import functions as F

from entlens.llm import toxicity
from tests_llm_data import make


def test_rare_short_and_aimed_terms(spark):
    rng = np.random.default_rng(6)
    plain = [f"plain{j}" for j in range(80)]
    rows, labels = [], []
    for i in range(1600):
        words = list(rng.choice(plain, 20))
        toxic = i % 2
        if toxic:
            words[5] = "vilewort" if i % 80 > 5 else ("raroinsulto", "sot", "kill you")[i % 80 // 2]
        elif i % 4 == 0:
            words[5] = "kill"
        rows.append((i, " ".join(words) + "."))
        labels.append((i, toxic))
    docs, labels = make(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    terms = toxicity.learn_terms(docs, labels)
    assert {"=vilewort", "=raroinsulto", "raroinsu", "=sot", "+kill"} <= set(terms) and "=kill" not in terms and not any(t.lstrip("=").startswith("plain") for t in terms)
    scored = toxicity.score_toxicity(docs, terms, keep=["doc_id"]).where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(scored) > 200 and all((r.score > toxicity.sigmoid(toxicity.PRIOR)) == (r.doc_id % 2 == 1) for r in scored)
