"""phash_pairs: every pair that meets the threshold, those of exact copies too."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from brute import phash_score
from conftest import SF_SMALL
from mediasift.operators import leaders
from mediasift.operators.leaders import similarity_pairs
from mediasift.operators.simjoin import PhashSpec


@pytest.mark.parametrize("block", [leaders.BLOCK, 3])
def test_pairs_of_copies_equal_brute_force(spark, monkeypatch, block):
    """a copy was listed with the first of its signature alone."""
    monkeypatch.setattr(leaders, "BLOCK", block)
    rnd = random.Random(5)
    base = [[rnd.getrandbits(64) - (1 << 63) for _ in range(2)] for _ in range(12)]
    near = [[h[0] ^ 3, h[1]] for h in base[:6]]
    sigs = [*base, *near, *[base[0]] * 9, *[near[0]] * 5, *[near[3]] * 2, base[4], [], None, base[1][:1], base[1][:1]]
    rnd.shuffle(sigs)
    rows = list(enumerate(sigs))
    df = spark.createDataFrame(rows, "video_id long, hashes array<long>")
    found = similarity_pairs(df, PhashSpec(5.0, 2), every_copy=True).collect()
    want = {(a, b): phash_score(x, y) for a, x in rows for b, y in rows
            if a < b and x and y and len(x) == len(y) and phash_score(x, y) <= 5}
    assert {(r.id_a, r.id_b): r.score for r in found} == want and len(found) == len(want) > 100


def test_query_and_sql_list_pairs_of_copies(spark, tmp_path):
    table = pq.read_table(f"{SF_SMALL}/embeddings.parquet")
    first = table.slice(0, 15)
    parts = [table]
    for k in (1, 2):  # three videos twice more
        at = table.schema.get_field_index("vec_id")
        parts.append(first.set_column(at, table.schema.field(at), [[v + 500_000 * k for v in first["vec_id"].to_pylist()]]))
    pq.write_table(pa.concat_tables(parts), tmp_path / "embeddings.parquet")
    found = entry.queries()["phash_pairs"](spark, str(tmp_path))
    got = {tuple(r) for r in found.select("id_a", "id_b", "score").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    want = {tuple(r) for r in con.execute(entry.oracle_sql()["phash_pairs"]).fetchall()}
    assert got == want and {(1, 100_001, 0.0), (100_001, 200_001, 0.0)} <= got
