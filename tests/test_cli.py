"""The command-line jobs on files written from the derived tables."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from semrec import cli, registry
from semrec.sources import fixtures as fx
from semrec.sources import writers as W


def test_corpus_command_matches_registered_job(spark, tmp_dir):
    seq = os.path.join(tmp_dir, "seq")
    items = os.path.join(tmp_dir, "items")
    W.write_sequences(fx.interactions(spark, SF_SMALL).select("user_id", "pos", "item_id"), seq)
    W.write_catalog(fx.catalog(spark, SF_SMALL), items)
    out = os.path.join(tmp_dir, "sid")
    cli.main(["corpus", "--kind", "sid", "--sequences", seq, "--items", items, "--out", out])
    got = spark.read.parquet(out)
    want = registry.QUERIES["sid_prediction_corpus"](spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_behaviors_and_evaluate_commands(spark, tmp_dir, capsys):
    raw = os.path.join(tmp_dir, "raw")
    fx.behaviors(spark, SF_SMALL).write.parquet(raw)
    out = os.path.join(tmp_dir, "beh")
    cli.main(["behaviors", "--log", raw, "--raw", "--out", out])
    n_items = spark.read.text(os.path.join(out, "items")).count()
    assert n_items == registry.QUERIES["item_metadata"](spark, SF_SMALL).count()
    lines = spark.read.text(os.path.join(out, "sequences"))
    assert lines.count() == registry.QUERIES["user_sequences"](spark, SF_SMALL).count()
    cands = os.path.join(tmp_dir, "cands")
    truth = os.path.join(tmp_dir, "truth")
    fx.candidates(spark, SF_SMALL).where(F.col("think_idx") == 0).write.parquet(cands)
    fx.truth(spark, SF_SMALL).write.parquet(truth)
    cli.main(["evaluate", "--candidates", cands, "--truth", truth])
    assert "hit@10" in capsys.readouterr().out
