"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (every row is
computed, nothing is collected).  ``vocabulary_store`` is the time to build the
versioned vocabulary of the records once; ``encode_ids`` and ``mask_labels`` are
given it, the other queries build their own.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

GIVEN = ("encode_ids", "mask_labels")     # take the vocabulary of the store
HEADLINE = ["tokenize_counts", "encode_ids", "mask_labels", "pack_blocks", "pad_left",
            "index_semi_join", "archive_roundtrip", "stream_masked"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from tokenloom.operators.vocab_store import open_vocabulary, token_counts
    from tokenloom.plans.queries import QUERIES, _records_tokens
    from tokenloom.session import build_session, scratch_path

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    def run(name, sf, vocab):
        df = QUERIES[name](spark, sf, vocab) if name in GIVEN else QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()

    def vocabulary(sf):
        return open_vocabulary(spark, scratch_path(spark, "bench-vocabulary"), token_counts(_records_tokens(spark, sf)), "records").read()

    # steady-state timing: one untimed pass of the same queries on the
    # smallest scale factor compiles the code paths in the JVM first
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        vocab = vocabulary(warm_dir)
        for name in names:
            run(name, warm_dir, vocab)

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    vocab = vocabulary(sf_dir)
    times["vocabulary_store"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        run(name, sf_dir, vocab)
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)

    import duckdb
    documents = f"{sf_dir}/documents.parquet" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/documents.parquet") else "")
    n_tokens = duckdb.sql(
        f"SELECT sum(len(regexp_extract_all(text, '([A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\r\\n])', 1)))::BIGINT "
        f"FROM read_parquet('{documents}')").fetchall()[0][0]
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_seconds", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus,
           "warmup": warm_dir if os.path.isdir(warm_dir) else None}
    if n_tokens:
        out["document_tokens"] = int(n_tokens)
        out["tokens_per_sec_encode"] = round(n_tokens / times["encode_ids"], 1) if "encode_ids" in times else None
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
