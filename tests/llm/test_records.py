"""Chat formatting and WARC: round trips."""
import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import chat_format as C
from quarry.llm import warc as W

NASTY = ["", None, "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|x<|", "\n", "a\n\nb ", "<n<|n|>", "\\", "é😀<|"]


def test_round_trip(spark):
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate([(r, x) for r in ("user", "assistant", "we<|ird\n<nrole", None) for x in NASTY])]
    rows += [(2, 0, "user", "same"), (2, 0, "user", "same"), (3, None, "assistant", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "7 AS position", "'x' AS formatted")
    out = C.render(C.paths(C.with_tree(df.select("conv_id", "turn", "role", "text"))))
    got = {r.conv_id: r for r in out.withColumn("turns", C.parse(F.col("formatted"))).collect()}
    for c in (1, None, 2, 3):
        want = sorted([(t if t is not None else -1, r or "", x or "") for cc, t, r, x in rows if cc == c], key=lambda z: z[0])
        assert [(t.role, t.text) for t in got[c].turns] == [z[1:] for z in want]
        learned = [x for _, r, x in want if r == "assistant"]
        assert len(got[c].loss) == len(learned)
        for span, x in zip(got[c].loss, learned):
            piece = got[c].formatted[span.start:span.end]
            assert spark.range(1).select(C.unescape(F.lit(piece)).alias("x")).first().x == x if "<" in x and len(x) < 99 else piece == x
    assert got[1].formatted.count(C.START) == len(got[1].turns)


def test_trees_give_ranked_branches(spark):
    #      1(1.0) -> 2(0.5) -> 4(0.1);  1 -> 3(0.9);  9 -> 10 is a tree of its own;  20 <-> 21 a circle
    rows = [(1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 0.5), (1, 3, 1, "assistant", "c", 0.9), (1, 4, 2, "user", "d", 0.1),
            (1, 9, 77, "user", "e", None), (1, 10, 9, "assistant", "f", 0.0), (1, 20, 21, "user", "g", 9.0), (1, 21, 20, "user", "h", 9.0)]
    rows += [(5, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(70)]
    df = spark.createDataFrame(rows, "conv_id long, node_id long, parent_id long, role string, text string, score double")
    found = {}
    for r in C.paths(df, branches=None).orderBy("position").collect():
        found.setdefault((r.conv_id, r.path_id, r["rank"]), []).append((r.position, r.text))
    assert found.pop((5, 69, 1)) == [(i, str(i)) for i in range(70)]
    assert found == {(1, 3, 1): [(0, "a"), (1, "c")], (1, 4, 2): [(0, "a"), (1, "b"), (2, "d")], (1, 10, 1): [(0, "e"), (1, "f")]}
    one = {(r.conv_id, r.path_id) for r in C.paths(df).collect()}
    assert one == {(1, 3), (1, 10), (5, 69)}
    assert C.render(C.paths(df.limit(0))).count() == 0


@pytest.mark.parametrize("keys", [100_000, 0])
def test_archive_round_trip(spark, tmpdir_path, monkeypatch, keys):
    monkeypatch.setattr(W, "BROADCAST_KEYS", keys)
    rows = [(3, "http://a", "x"), (1, "http://b", "x"), (2, None, "é" * 1000), (7, "u\r\nX: y", None), (8, "u", ""), (9, "u", "WARC/1.1\r\n\r\nHTTP\r\n\r\n"),
            (None, "n", "x"), (None, "n", "only"), (5, "d", "dup"), (5, "d", "dup"), (11, "big", "z" * 2_000_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    W.write_archive(df, f"{tmpdir_path}/a")
    got = W.parse_records(W.read_records(spark, f"{tmpdir_path}/a")).collect()
    assert len(got) == len(rows)
    assert spark.read.parquet(f"{tmpdir_path}/a/payloads").count() == len({h or "" for _, _, h in rows})
    for r in got:
        own = [h or "" for i, _, h in rows if i == r.page_id]
        digests = [base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for h in own]
        assert r.payload_digest in digests
        if r.record_type == "response":
            assert bytes(r.payload).decode() in own and r.refers_to is None
    kind = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id is not None}
    assert kind == {1: ("response", None), 2: ("response", None), 3: ("revisit", 1), 5: ("response", None), 7: ("response", None), 8: ("revisit", 7), 9: ("response", None), 11: ("response", None)}
    assert next(r.url for r in got if r.page_id == 7) == "u%0D%0AX: y"
    W.write_archive(df, f"{tmpdir_path}/b", min_bytes=2)
    small = W.parse_records(W.read_records(spark, f"{tmpdir_path}/b")).filter("page_id IN (1, 3, 7, 8)").collect()
    assert all(r.record_type == "response" for r in small)
    W.write_archive(df.limit(0), f"{tmpdir_path}/c")
    assert W.read_records(spark, f"{tmpdir_path}/c").count() == 0


def test_a_changed_payload_is_found(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    W.write_archive(df, f"{tmpdir_path}/a")
    bad = spark.read.parquet(f"{tmpdir_path}/a/payloads").select("sha256", F.encode(F.lit("y"), "UTF-8").alias("payload")).collect()
    spark.createDataFrame(bad).write.mode("overwrite").parquet(f"{tmpdir_path}/a/payloads")
    with pytest.raises(Exception, match="digest"):
        W.parse_records(W.read_records(spark, f"{tmpdir_path}/a")).collect()
