"""The three stages on a small tree of articles, and their failure modes."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import articles, encoders, gates, images, index, reports, retrieval, session, stats
from folioscope.sources import mdx_corpus, safetensors, tables
from folioscope.streaming import ingest


def png(width, height, seed=0, depth=3):
    return images.encode_png(np.random.default_rng(seed).integers(0, 256, (height, width, depth)).astype(np.uint8))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("corpus")

    def put(path, body):
        full = base / path
        full.parent.mkdir(parents=True, exist_ok=True)
        full.write_bytes(body if isinstance(body, bytes) else body.encode())

    put("index.mdx", "---\ntitle: Root\npath: /r\nx: 1\n---\n# H\n\nRoot article about cameras and brokers, long enough to pass.\n")
    put("root/index.mdx", "short")
    put("a/index.mdx", "# A title\n\n![x](x.png) ![y](../shared/s.png) ![g](gone.png) ![d](d.png) ![n](notes.txt) ![c](bad.png) ![c](bad.png) ![h](http://x/y.png)\n\nSome prose that is long enough to be content.\n")
    put("a/b/index.mdx", "# B\n\n![y](../../shared/s.png) ![y](../../shared/s.png)\n\nMore prose about motion detection and recordings on a server.\n")
    put(".h/index.mdx", "import X from 'x'\n")
    put("_u/index.mdx", b"")
    put("bad/index.mdx", b"\xff\xfe")
    put("crlf/index.mdx", b"x\r\ny and enough more words to be over forty characters long")
    put("yaml/index.mdx", "---\n[a\n---\nA body that is long enough to be content without a flag.")
    put("a/x.png", png(20, 10))
    put("a/notes.txt", "n")
    put("a/bad.png", b"no image")
    put("shared/s.png", png(4, 4, 1, 4))
    os.makedirs(base / "a/d.png")
    return str(base)


@pytest.fixture(scope="module")
def build(spark, root):
    return articles.build_articles(spark, root, images.PngDecoder(), max_edge=10)


@pytest.fixture(scope="module")
def rows(build):
    return {r["id"]: r for r in build.articles.collect()}


def test_discovery_sees_hidden_and_empty_files_in_byte_order(spark, root):
    found = mdx_corpus.read_corpus(spark, root).orderBy("row_idx").select("rel_path", "row_idx").collect()
    assert [r["rel_path"] for r in found] == sorted((r["rel_path"] for r in found), key=str.encode) and len(found) == 9
    assert [r["row_idx"] for r in found] == list(range(9))
    assert mdx_corpus.read_corpus(spark, root, limit=2).count() == 2
    order = [r["rel_path"] for r in found]
    assert order.index("a/b/index.mdx") < order.index("a/index.mdx")


def test_article_table(rows, build):
    assert set(rows) == {"root", "root#70eb9e39", "a", "a/b", ".h", "_u", "crlf", "yaml"}
    assert (rows["root"]["title"], rows["root"]["source_path"], rows["root"]["metadata"]) == ("Root", "/r", '{"x": 1}')
    assert rows["a"]["title"] == "A title" and rows["a"]["image_refs"] == ["x.png", "../shared/s.png"]
    assert [images.PngDecoder().probe(i["bytes"])[:3] for i in rows["a"]["images"]] == [(10, 5, "RGB"), (4, 4, "RGBA")]
    assert rows["a/b"]["image_refs"] == ["../../shared/s.png"] * 2
    assert rows[".h"]["content"] == "" and rows[".h"]["images"] == [] and rows["_u"]["text"] == ""
    assert rows["crlf"]["text"].startswith("x\ny")
    assert [tuple(r) for r in build.failed.collect()] == [("bad/index.mdx", "not readable as UTF-8")]


def test_dropped_items_and_counters(build):
    bad = [(r["ref"], r["error"].split(":")[0]) for r in build.bad_items.collect()]
    assert bad[0] == ("gone.png", "missing")
    assert sorted(bad[1:], key=str) == sorted([("d.png", "not-file"), ("notes.txt", "unsupported-ext"), ("bad.png", "corrupt"), ("bad.png", "corrupt"), (None, "frontmatter")], key=str)
    counted = stats.counters(build)
    assert {k: counted[k] for k in ("articles_total", "converted", "failed", "rows_with_images", "resolved_local_image_refs", "unique_image_files_embedded", "missing_refs_dropped", "corrupt_images_dropped", "images_downscaled", "max_images_in_one_article")} == {
        "articles_total": 9, "converted": 8, "failed": 1, "rows_with_images": 2, "resolved_local_image_refs": 4, "unique_image_files_embedded": 2, "missing_refs_dropped": 1, "corrupt_images_dropped": 2, "images_downscaled": 1, "max_images_in_one_article": 2,
    }
    assert set(counted["warn_empty_content"]) == {".h", "root#70eb9e39"} and counted["histogram"] == {0: 6, 2: 2}
    assert gates.strict_failures(counted)
    assert stats.compact_histogram({0: 1, 1: 2, 2: 3, 3: 4, 9: 5}) == "0: 1, 1: 2, 2: 3, 3: 4, ... 9: 5"


def test_gates(spark, build):
    found = gates.hard_gate(build.articles, build.flagged, 8, images.PngDecoder()).collect()
    assert [(r["rule"], r["id"]) for r in found] == [("C1", "_u")]
    assert [r["rule"] for r in gates.hard_gate(build.articles, build.flagged, 9, images.PngDecoder()).collect()].count("rows") == 1
    broken = build.articles.withColumn("images", F.when(F.col("id") == "a", F.slice("images", 1, 1)).when(F.col("id") == "root", F.lit(None)).otherwise(F.col("images")))
    nulls = build.articles.withColumn("images", F.transform("images", lambda i: F.when(F.lit(False), i)))
    assert [r["id"] for r in gates.round_trip_rule(nulls).orderBy("id").collect()] == ["a", "a/b"] and gates.round_trip_rule(build.articles).count() == 0
    rules = {(r["rule"], r["id"]) for r in gates.handoff_gate(broken, build.flagged, 100).collect()}
    assert {("C4", "a"), ("C2", "root"), ("C1", "_u")} <= rules
    grey = build.articles.withColumn("images", F.transform("images", lambda i: F.struct(F.lit(b"x").alias("bytes"), F.lit(None).cast("string").alias("path"))))
    assert gates.image_rule(grey, images.PngDecoder()).count() == 4


def test_verification(build):
    ids = build.articles.select("row_idx", "id")
    said = gates.verify(build.articles, ids, images.PngDecoder())
    assert said["rows"] == 8 and said["images_total"] == 4 and said["images_sample_checked"] == 4
    assert said["determinism_check"] == "rederived" and said["histogram"]["2"] == 2
    assert [f for f in said["failures"] if "_u" not in f] == []
    assert [r["row_idx"] for r in said["sample_rows"]] == [0, 4, 7] and gates.large_rows(build.articles, 2).count() == 2
    other = ids.withColumn("id", F.when(F.col("row_idx") == 3, "other").otherwise(F.col("id")))
    assert any("differs first at row 3" in f for f in gates.verify(build.articles, other, images.PngDecoder())["failures"])


def test_stride_follows_the_number_of_images(spark):
    one = F.array_repeat(F.struct(F.lit(b"x").alias("bytes"), F.lit(None).cast("string").alias("path")), 3)
    rows = spark.range(267).select(F.col("id").alias("row_idx"), F.col("id").cast("string").alias("id"), F.array_repeat(F.lit("r"), 3).alias("image_refs"), one.alias("images"))
    sampled = gates.sampled_images(rows).collect()
    assert sorted(3 * r["row_idx"] + r["pos"] for r in sampled) == list(range(0, 801, 3))


def test_shards_and_reports(spark, build, tmp_path):
    out = str(tmp_path / "out")
    os.makedirs(out)
    open(f"{out}/old.parquet", "w").close()
    written = tables.write_shards(build.articles, out, 3)
    assert [os.path.basename(w) for w in written] == [f"train-{k:05d}-of-00003.parquet" for k in range(3)] and not os.path.exists(f"{out}/old.parquet")
    again = tables.read_articles(spark, f"{out}/*.parquet")
    assert again.filter("size(images) = 0").count() == 6 and again.filter("images IS NULL").count() == 0
    with pytest.raises(ValueError):
        tables.write_shards(build.articles.limit(0), out)
    reports.build_report(out, build, [], [], 1.234)
    with open(f"{out}/REPORT.md.json") as file:
        keys = set(json.load(file))
    assert keys == set("articles_total converted failed rows_with_images text_only_rows resolved_local_image_refs unique_image_files_embedded missing_refs_dropped corrupt_images_dropped not_file_dropped unsupported_ext_dropped gif_flattened images_downscaled max_images_in_one_article warn_empty_content histogram hard_gate hard_gate_violations smoke_test smoke_msg max_image_edge png_compresslevel wall_seconds out".split())


class Flaky(encoders.HashEncoder):
    """Runs out of memory above two rows, and fails for good on a marked text."""

    def __init__(self, dim=64, broken=None):
        super().__init__(dim)
        self.broken = broken

    def encode_documents(self, texts, images):
        if self.broken and any(self.broken in t for t in texts or ()):
            raise RuntimeError("lost")
        if len(texts if texts is not None else images) > 2:
            raise MemoryError
        return super().encode_documents(texts, images)


def some_articles(spark, n):
    return spark.range(n).select(F.col("id").alias("row_idx"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("id"), F.concat(F.lit("Title "), F.col("id").cast("string")).alias("title"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("source_path"), F.lit("t").alias("text"), F.concat(F.lit("words number"), F.col("id").cast("string"), F.lit(" and common")).alias("content"), F.array().cast("array<string>").alias("image_refs"), F.array().cast("array<struct<bytes:binary,path:string>>").alias("images"), F.lit("{}").alias("metadata"))


def test_index_is_resumed_reused_and_rebuilt(spark, tmp_path):
    path, rows = str(tmp_path / "index"), some_articles(spark, 300)
    with pytest.raises(Exception, match="lost"):
        index.build_or_resume(rows, Flaky(broken="number290 "), path, modality="text", parts_per_wave=1)
    assert index.read_progress(path)["status"] == "partial" and index.read_progress(path)["completed_parts"] == 2
    with pytest.raises(index.StageFailure):
        index.open_index(spark, path)
    said = index.build_or_resume(rows, Flaky(), path, modality="text")
    assert said["resumed_parts"] == 2 and index.shape(index.open_index(spark, path)) == (300, 64, 64, True)
    assert sorted(r["rows"] for r in index.committed(spark, said["embed_file"], 64).collect()) == [44, 128, 128]
    assert (said["effective_batch"], said["oom_halvings"]) == (2, 2)
    assert index.build_or_resume(rows, Flaky(), path, modality="text")["reused_existing"]
    changed = index.build_or_resume(rows, Flaky(), path, part_rows=100, modality="text")
    assert not changed["reused_existing"] and changed["embed_file"] != said["embed_file"]
    assert not index.build_or_resume(rows, Flaky(), path, part_rows=100, modality="text", force=True)["reused_existing"]
    with open(f"{path}/_progress.json", "w") as file:
        file.write("{")
    assert index.read_progress(path) is None
    with pytest.raises(Exception, match="empty text"):
        index.build_or_resume(rows.withColumn("content", F.lit("")).withColumn("text", F.lit(None).cast("string")), Flaky(), path, modality="text")


def test_row_images():
    tiles = [png(3, 3, k) for k in range(5)]
    assert images.row_image([], "primary") == "" and images.row_image(tiles, "primary") == tiles[0]
    assert images.decode_png(images.row_image(tiles, "concat", 8)).shape == (16, 24, 3)
    assert images.row_image(tiles, "native") == tiles
    with pytest.raises(ValueError):
        images.row_image(tiles, "other")


def test_png_filters_round_trip():
    import struct
    import zlib

    g = np.random.default_rng(3)
    pixels = g.integers(0, 256, (5, 4, 3))
    flat = pixels.reshape(5, 12)
    body = b""
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        line = []
        for x in range(12):
            left, up, corner = (flat[y, x - 3] if x >= 3 else 0), (flat[y - 1, x] if y else 0), (flat[y - 1, x - 3] if y and x >= 3 else 0)
            p = left + up - corner
            paeth = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            line.append(int(flat[y, x] - (0, left, up, (left + up) // 2, paeth)[kind]) & 255)
        body += bytes([kind, *line])
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")
    assert (images.decode_png(data) == pixels).all()


def packed_png(width, height, bits, colour, rows, extra=b""):
    import struct
    import zlib

    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    body = b"".join(b"\0" + r for r in rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, 0)) + extra + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b""), chunk


def test_png_colour_types_and_bmp():
    _, chunk = packed_png(1, 1, 8, 0, [b"\0"])
    palette = chunk(b"PLTE", bytes([1, 2, 3, 9, 8, 7])) + chunk(b"tRNS", bytes([0]))
    made = images.decode_png(packed_png(3, 1, 1, 3, [bytes([0b01000000])], palette)[0])
    assert made.tolist() == [[[1, 2, 3, 0], [9, 8, 7, 255], [1, 2, 3, 0]]]
    assert images.decode_png(packed_png(2, 1, 4, 0, [bytes([0x0F])])[0]).tolist() == [[[0, 0, 0, 255], [255, 255, 255, 255]]]
    assert images.decode_png(packed_png(1, 1, 16, 2, [bytes([5, 1, 6, 1, 7, 1])])[0]).tolist() == [[[5, 6, 7]]]
    assert images.decode_png(packed_png(1, 1, 8, 4, [bytes([5, 9])])[0]).tolist() == [[[5, 5, 5, 9]]]
    head = b"BM" + (54 + 16).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
    info = (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"\1\0\x18\0" + bytes(24)
    bmp = head + info + bytes([1, 2, 3, 4, 5, 6, 0, 0, 7, 8, 9, 10, 11, 12, 0, 0])
    assert images.decode_bmp(bmp).tolist() == [[[9, 8, 7], [12, 11, 10]], [[3, 2, 1], [6, 5, 4]]]
    assert images.PngDecoder().probe(bmp)[:3] == (2, 2, "RGB") and images.decode_png(images.PngDecoder().normalise(bmp, 0, False)[0]).shape == (2, 2, 3)
    for broken in (packed_png(1, 1, 16, 3, [b"\0\0"])[0], b"BM" + bytes(60), b"GIF89a"):
        with pytest.raises(Exception):
            images.decode_pixels(broken)


def test_unreadable_articles_leave_no_gap_and_images_are_decoded_once(spark, tmp_path):
    for name, body in (("a", b"\xff"), ("b", b"# B\n\n![x](../x.png) words enough to be content of an article"), ("c", b"\xfe"), ("d", b"![x](../x.png) words enough to be content of an article")):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "index.mdx").write_bytes(body)
    (tmp_path / "in/x.png").write_bytes(png(4, 4))
    seen = tmp_path / "seen"

    class Counting(images.PngDecoder):
        def normalise(self, data, max_edge, keep_frames):
            with open(seen, "a") as file:
                file.write("x")
            return super().normalise(data, max_edge, keep_frames)

    built = articles.build_articles(spark, str(tmp_path / "in"), Counting())
    out = tmp_path / "out"
    out.mkdir()
    written = tables.write_shards(built.articles, str(out), 1)
    assert [os.path.basename(w) for w in written] == ["train-00000-of-00002.parquet", "train-00001-of-00002.parquet"]
    reports.build_report(str(out), built, [], [], 1.0)
    assert stats.counters(built)["failed"] == 2 and seen.read_text() == "x"
    assert [tuple(r) for r in tables.read_articles(spark, f"{out}/*.parquet").select("row_idx", "id").orderBy("row_idx").collect()] == [(0, "b"), (1, "d")]


def test_order_check_sees_missing_and_extra_rows(spark):
    rows = lambda *own: spark.createDataFrame([(k, x) for k, x in own], "row_idx long, id string")
    expected = rows((0, "a"), (1, "b"), (2, "c"))
    check = lambda found: [tuple(r) for r in gates.first_divergence(found, expected).collect()]
    assert check(rows((0, "a"), (1, "b"))) == [] and check(expected) == []
    assert check(rows((0, "a"), (2, "c"))) == [(1, "b", None)]
    assert check(rows((0, "a"), (1, "b"), (2, "c"), (3, "d"))) == [(3, None, "d")]


def test_retrieval_and_smoke(spark, build, tmp_path):
    rows = build.articles.filter("content <> ''")
    encoder = encoders.HashEncoder()
    vectors = index.encode(index.with_parts(rows), encoder, "text").cache()
    found = retrieval.topk(vectors, encoder.encode_queries(["motion detection recordings server"])[0], 3).collect()
    shown = retrieval.hydrate(spark.createDataFrame(found), tables.corpus_view(rows)).collect()
    assert shown[0]["id"] == "a/b" and [r["rank"] for r in shown] == [1, 2, 3]
    probes = [{"kind": "in-domain", "query": "motion detection recordings on a server", "keywords": ["a/b"]}, {"kind": "out-of-domain", "query": "zyx", "keywords": []}]
    said = retrieval.smoke(vectors, rows, encoder, probes)
    assert said["passed"] and said["probes"][0]["keyword_hit"] == "a/b" and said["image_query"]["source_id"] == "a/b"
    document = reports.index_report(str(tmp_path), "x", "d", gates.verify(build.articles, None, images.PngDecoder()), {"embed_file": "e", "num_rows": 7, "dim": 64, "dtype": "float32"}, said)
    assert document["result"] == "PASS" and os.path.exists(tmp_path / "REPORT_x.json")
    tie = spark.createDataFrame([("in-domain", 0.5), ("out-of-domain", 0.5)], "kind string, top1_score double")
    assert not retrieval.verdict(tie).first()["passed"]
    assert retrieval.rank_of(retrieval.topk(vectors, encoder.encode_queries(["x"])[0], 1), -5).first()["rank"] == -1
    bad = spark.createDataFrame([(0, [float("nan")] * 64)], "row_idx long, embedding array<double>")
    with pytest.raises(Exception, match="non-finite"):
        retrieval.topk(bad, encoder.encode_queries(["x"])[0], 1).collect()


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_batch_topk_does_not_depend_on_partitions(spark, sf, parts):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("row_idx"), "embedding").repartition(parts)
    asked = vectors.filter("row_idx % 50 = 0").select(F.col("row_idx").alias("query_id"), "embedding")
    fast = retrieval.topk_batch(vectors, asked, 5, block=4).orderBy("query_id", "rank").collect()
    plain = retrieval.topk_native(vectors, asked, 5).orderBy("query_id", "rank").collect()
    assert [r[:3] for r in fast] == [r[:3] for r in plain] and len(fast) == 50


def test_session(spark):
    rows = some_articles(spark, 12)
    encoder = encoders.HashEncoder()
    own = session.Session(rows, index.encode(index.with_parts(rows), encoder, "text"), encoder, top_k=3)
    assert own.execute("show").status == "error" and own.execute("repeat").status == "error"
    found = own.execute("words number7 and common")
    assert found.value[0]["id"] == "d7" and len(found.value) == 3
    assert own.execute("show 1").value["title"] == "Title 7"
    assert own.execute("show 9").status == "error" and own.execute("show x").status == "error"
    assert own.execute("topk 99").value == 12 and own.execute("topk").value == 12 and own.execute("topk z").status == "error"
    assert len(own.execute("repeat").value) == 12
    assert own.execute("image /no/such.png").status == "ok"
    assert own.execute("stats").value["rows"] == 12 and own.execute("help").status == "ok" and own.execute("  ").status == "ok"
    for k in range(30):
        own.execute("clear")
    assert len(own.execute("history").value) == 20 and own.execute("QUIT").status == "exit"


def test_corpus_view_fills_absent_columns(spark):
    view = tables.corpus_view(spark.createDataFrame([(5, "x")], "row_idx long, text string")).first()
    assert (view["id"], view["content"], view["source_path"], view["image_refs"]) == ("row-5", "x", "row-5", [])


@pytest.mark.parametrize("bf16", [True, False])
def test_matrix_files_round_trip(spark, tmp_path, bf16):
    path = str(tmp_path / "m.safetensors")
    values = np.random.default_rng(1).standard_normal((50, 8)).astype(np.float32)
    safetensors.write_matrix(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(values)], "row_idx long, embedding array<float>"), path, bf16=bf16)
    found = np.array([r[0] for r in safetensors.read_matrix(spark, path, slice_rows=7).orderBy("row_idx").select("embedding").collect()])
    assert np.allclose(found, values, rtol=1 / 256 if bf16 else 0, atol=0)
    with pytest.raises(KeyError):
        safetensors.read_matrix(spark, path, "other")


def test_landed_articles_are_streamed_into_an_index(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for k in range(2):
        some_articles(spark, 10).withColumn("row_idx", F.col("row_idx") + 10 * k).write.mode("append").parquet(landing)
        run = ingest.stream_into_index(ingest.stream_articles(spark, landing), encoders.HashEncoder(), str(tmp_path / "index"), str(tmp_path / "cp"))
        run.awaitTermination()
        assert spark.read.parquet(str(tmp_path / "index")).count() == 10 * (k + 1)
