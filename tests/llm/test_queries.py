"""Registered queries return what their methods deal out."""

import numpy as np
import pytest

pytest.importorskip("terrace.llm")
pytest.importorskip("public_tokenizers")

from terrace.llm import token_rows  # noqa: E402
from terrace.llm.mixing import SHARDS  # noqa: E402
from terrace.llm.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, " ".join(f"w{i}" for _ in range(1 + 37 * i % 200)), f"s{i % 3}") for i in range(200)] + [(300, None, "s0"), (301, "word " * 5_000, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{path}/documents.parquet")
    return path


def test_op3_returns_the_draws_with_their_shards(spark, folder):
    rows = QUERIES["op3_mixing"](spark, folder).collect()
    draws = [d for r in rows for d in r.draws]
    assert len(rows) == 202 and all(sum(d.words for d in r.draws) == r.taken for r in rows)
    assert all(0 <= d.shard < SHARDS for d in draws) and len({d.shard for d in draws}) > SHARDS / 2


def test_op6_returns_positions_that_reset_at_each_piece(spark, folder, tmp_path):
    frame = QUERIES["op6_token_rows"](spark, folder)
    token_rows.write_matrix(frame, str(tmp_path / "matrix"))
    rows = spark.read.parquet(str(tmp_path / "matrix")).collect()
    assert len(rows) > 3 and sum(len(r.doc_ids) for r in rows) >= 202
    for r in rows:
        want = [i for a, b in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:]) for i in range(b - a)] + list(range(token_rows.WIDTH - r.n_tokens))
        assert np.frombuffer(r.position_ids, dtype="<u2").tolist() == want
