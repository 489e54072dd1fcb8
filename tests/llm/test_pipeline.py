import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tessera.llm import pii
from tessera.llm.queries import op4_deobfuscated_toxicity, tokenizer_json
from tests.llm import test_decontaminate as td
from tests.llm import test_minhash as tm

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    toxic = {r.doc_id for r in op4_deobfuscated_toxicity(spark, SF).where("predicted = 1").collect()}
    left = {i: d.text for i, d in docs.items() if i not in toxic}
    left = {i: left[i] for i, (_, c) in tm.brute(list(left.items())).items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: t for i, t in left.items() if not td.brute(t, items)}
    got = {r.doc_id: r for r in cp.run(spark, SF).collect()}
    assert set(got) == set(left) and len(left) < len(docs)
    plain = Tokenizer.from_str(tokenizer_json())
    for i, r in got.items():
        assert r.lang == docs[i].lang and r.source == docs[i].source
        assert not [s for s in pii.base_spans(r.text)] and r.n_chars == len(r.text)
        if not pii.base_spans(left[i]):
            assert r.text == left[i]
        assert np.frombuffer(r.token_ids, "<u4").tolist() == plain.encode(r.text, add_special_tokens=False).ids


def test_stages_keep_columns(spark, tmp_path):
    text = "The onea hetion of thering and eringst to ofand in thewh"
    rows = [(1, None, "en", None, 0, "x"), (2, "", None, "s", 0, "x"), (3, text, "en", "s", 9, "x"), (3, text, "en", "s", 9, "x"), (4, text.upper(), "en", "s", 9, "x"), (None, "some rows have no id and stay mail a@b.cd", "en", "s", None, "x"), (None, text, "en", "s", 9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this kind is there at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (df, df.limit(0)):
        for name, step in cp.STAGES[:-1]:
            docs = cp.stage(step(spark, docs, str(tmp_path)), name)
            assert docs.columns == df.columns
        n = cp.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        if n:
            assert sorted((r.doc_id or 0) for r in n) == [0, 1, 2, 3]
            assert {r.doc_id: r.text for r in n}[None] == "some rows have no id and stay mail [EMAIL]"
