"""The pipeline's stages against what plain Python says of the same documents."""

import os

import numpy as np
import pytest

import corpus_pipeline
from moothall.llm import common
from tests.llm.test_operators import SYLLABLES, brute_leaks, brute_spans, components_of, shingle_set, speech


def corpus():
    rows = [(i, speech(lang, 50 + i, 20 + i % 30), lang) for i, lang in enumerate(list(SYLLABLES) * 25)]
    item = speech("bb", 9999, 14)
    rows += [(200, rows[3][1], "aa"), (201, rows[3][1] + " extra", "aa"), (202, f"{speech('bb', 1, 20)} {item}", "bb")]
    rows += [(203, f"{speech('cc', 2, 20)} password = abcdefgh12345678", "cc"), (204, None, "aa"), (205, " ?! ", "aa"), (206, "", None)]
    return rows, [(1, item), (2, None)]


def test_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    left = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    sets = [shingle_set(t) for _, t in left]
    links = [(a, b) for a in range(len(left)) for b in range(a) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    classes = components_of(len(left), links)
    left = [x for k, x in enumerate(left) if classes[k] == k]
    left = [(i, t) for i, t in left if not brute_leaks(t, items)[1]]
    assert set(out) == {i for i, _ in left} and {200, 201, 202, 204, 205, 206}.isdisjoint(out)

    import base64

    import public_tokenizers as public
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, t in left:
        for a, _, b, _ in reversed(brute_spans(t)):
            t = t[:a] + "[SECRET]" + t[b:] if t[a:b] not in ("[SECRET]",) else t
        r = out[i]
        if i != 203:
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == encoding.encode_ordinary(t)
            assert r["n_chars"] == len(t)
        assert r["decodes"]
    assert "abcdefgh12345678" not in encoding.decode(np.frombuffer(bytes(out[203]["ids"]), "<u4").tolist())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_no_documents(spark, tmp_path, name, stage):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    out = stage(spark, common.table(spark, str(tmp_path), "documents"), str(tmp_path))
    assert out.count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == list(corpus_pipeline.COLUMNS)


def test_checkpoints_are_shared(spark):
    common.ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert named is None or spark.sparkContext.getCheckpointDir().startswith(named) or os.path.basename(named)
