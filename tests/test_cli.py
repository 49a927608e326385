"""The command-line jobs (train, score) on JSON corpora derived from the tables."""

from chirpflow.__main__ import main
from chirpflow.plans import queries as Q
from chirpflow.session import scratch_path
from conftest import SF_MID


def test_train_then_score_from_json(spark, capsys):
    base = scratch_path(spark, "test-cli")
    docs = Q._docs(spark, SF_MID).select("doc_id", "text")
    labels = Q.read_table(spark, SF_MID, "labels")
    for name, q in (("pos", 1), ("neg", 0)):
        (docs.join(labels.filter(f"quality = {q}").select("doc_id"), "doc_id")
         .select("text").write.json(f"{base}/{name}"))
    assert main(["train", "--positive", f"{base}/pos", "--negative", f"{base}/neg",
                 "--model-dir", f"{base}/models"], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert [ln.split("\t")[0] for ln in lines] == ["lr", "nb"]
    assert main(["score", "--model", f"{base}/models/nb", "--input", f"{base}/pos",
                 "--output", f"{base}/scored"], spark=spark) == 0
    scored = spark.read.parquet(f"{base}/scored")
    assert scored.count() == spark.read.json(f"{base}/pos").count()
    assert set(r.prediction for r in scored.select("prediction").distinct().collect()) <= {0.0, 1.0}
