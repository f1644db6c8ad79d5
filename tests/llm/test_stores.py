"""WARC bundles, source mixing, SentencePiece and top-k search against plain versions."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from odflow.llm import common, mixing, mtree, sentencepiece, warc

PAGES = "page_id long, url string, html string, payload string, keeper long"


def pages(spark):
    rng = random.Random(2)
    big = ["".join(rng.choice("abcdefé") for _ in range(1500)) for _ in range(3)]
    rows = [(k, f"http://x.example/{k}", rng.choice([*big, "small", "", None, f"own {k} " * 400])) for k in range(120)]
    rows += [(500, None, big[0]), (500, "u", big[0]), (None, "http://n.example/", big[1]), (None, None, None),
             (501, "a b\r\nc", "x" * 300_000)]
    return rows, spark.createDataFrame([(*row, "clash", 1) for row in rows], PAGES)


def test_archives_give_every_record_back(spark, tmp_path):
    rows, table = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_bundles(table.repartition(3), path, bundle_bytes=4096, frame_bytes=2000)
    index = warc.read_index(spark, path)
    got = index.collect()
    keeper = {}
    for page_id, _, html in rows:
        if len((html or "").encode()) >= 1000 and page_id is not None:
            keeper[html] = max(page_id, keeper.get(html, -1))

    def key(r):
        return tuple((v is None, v) for v in r)

    wanted = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        first = keeper.get(html) if len(payload) >= 1000 else None
        revisit = first is not None and first != page_id
        wanted.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                       first if revisit else None))
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert len({r["bundle"] for r in got}) > 3
    stored = warc.read_records(spark, path, index.filter("page_id = 501 OR page_id < 5").filter("record_type = 'response'")).collect()
    texts = {page_id: (html or "").encode() for page_id, _, html in rows}
    assert stored and all(bytes(r["payload"]) == texts[r["page_id"]] for r in stored)


def test_a_bundle_is_a_plain_zstandard_stream(spark, tmp_path):
    _, table = pages(spark)
    path = tmp_path / "warc"
    warc.write_bundles(table.coalesce(1), str(path))
    file, = path.glob("part-*")
    packed = file.read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True).read()
    frames = warc.read_seek_table(packed)
    assert whole.count(b"WARC/1.1\r\n") == 125 == len(warc.read_record_map(packed)) and 3 <= len(frames) < 60
    assert sum(unpacked for _, _, unpacked in frames) == len(whole)


def test_a_record_is_cut_out_of_one_frame(spark, tmp_path, monkeypatch):
    rows, table = pages(spark)
    path = tmp_path / "warc"
    warc.write_bundles(table.coalesce(1), str(path), frame_bytes=20_000)
    index, places = warc.read_index(spark, str(path)), warc.read_map(spark, str(path))
    columns = ["page_id", *[field.split()[0] for field in warc.PLACE.split(", ")]]
    assert sorted(map(str, places.select(columns).collect())) == sorted(map(str, index.select(columns).collect()))
    per_frame = [r["count"] for r in places.groupBy("bundle", "frame").count().collect()]
    # Frames hold several records, and the very large one has its own.
    assert max(per_frame) > 5 and sum(per_frame) == 125 and len(per_frame) < 40
    file, = path.glob("part-*")
    opened = []
    plain = zstandard.ZstdDecompressor()

    class Counted:
        def decompress(self, packed):
            opened.append(len(packed))
            return plain.decompress(packed)

    monkeypatch.setattr(warc.zstandard, "ZstdDecompressor", Counted)
    one = places.filter("page_id = 501").first()
    block, = warc.records_at(file.read_bytes(), [(one["frame_offset"], one["frame_bytes"], one["offset"], one["record_bytes"])])
    assert block == b"x" * 300_000 and opened == [one["frame_bytes"]]


def test_an_empty_archive(spark, tmp_path):
    warc.write_bundles(spark.createDataFrame([], PAGES), str(tmp_path / "w"))
    assert warc.read_index(spark, str(tmp_path / "w")).collect() == []


def plain_pfair(parts, blocks):
    """Slot by slot, over all blocks: of those released the one due first."""
    done, slot, out = dict.fromkeys(blocks, 0), 0, []
    names = sorted(blocks, key=lambda n: (n is None, n or ""))
    while any(done[n] < blocks[n] for n in names):
        ready = []
        for at, n in enumerate(names):
            j = done[n]
            if j < blocks[n] and math.floor(j / parts[n]) <= slot:
                ready.append((math.ceil((j + 1) / parts[n]), math.floor(j / parts[n]), at, n, j))
        if ready:
            *_, n, j = min(ready)
            out.append((slot, n, j))
            done[n] += 1
        slot += 1
    return out


@pytest.mark.parametrize("seed", range(20))
def test_pfair_deviates_by_less_than_a_block(seed):
    """From the weights themselves, at every slot of a long schedule in which no source runs out."""
    rng = random.Random(seed)
    weights = {f"s{k}": rng.random() ** 3 + 0.001 for k in range(rng.randrange(1, 40))}
    parts = mixing.shares(weights)
    assert sum(parts.values()) == 1
    slots = 20_000
    done = dict.fromkeys(weights, 0)
    plenty = dict.fromkeys(weights, slots)
    for at, (slot, name, block) in zip(range(slots), mixing.pfair(parts, plenty)):
        assert slot == at and block == done[name]
        done[name] += 1
        if slot % 97 == 0 or slot > slots - 50:
            assert all(abs(done[other] - parts[other] * (slot + 1)) < 1 for other in weights)


@pytest.mark.parametrize("seed", range(8))
def test_pfair_equals_a_plain_schedule(seed):
    rng = random.Random(seed)
    weights = {name: rng.choice([1.0, 0.1, 3.5, rng.random()]) for name in ["a", "b", "c", None, "d"][: rng.randrange(1, 6)]}
    blocks = {name: rng.randrange(0, 60) for name in weights}
    parts = mixing.shares(weights)
    assert list(mixing.pfair(parts, blocks)) == plain_pfair(parts, blocks)


def test_schedule_places_every_row_once(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["hot"] * 6 + ["a", "b", None]), 9) for k in range(3000)] + [(7, "hot", 9)] * 5 + [(None, "a", 9)]
    keys = spark.createDataFrame(rows, "doc_id long, source string, slot int").withColumn("key", F.xxhash64("doc_id"))
    for max_blocks, size in ((1000, 8), (50, 64)):
        got = mixing.schedule(keys, ["key", "doc_id"], block_rows=8, max_blocks=max_blocks).collect()
        assert len(got) == len(rows) and len({r["position"] for r in got}) == len(rows)
        by_source = {}
        for r in sorted(got, key=lambda r: r["position"]):
            by_source.setdefault(r["source"], []).append(r)
        for found in by_source.values():
            assert [r["rank"] for r in found] == list(range(len(found)))
            assert all(r["block"] == r["rank"] // size for r in found)
        sizes = {name: len(found) for name, found in by_source.items()}
        plain = plain_pfair(mixing.shares(mixing.tempered_weights(sizes)), {name: -(-n // size) for name, n in sizes.items()})
        slots = {(name, block): slot for slot, name, block in plain}
        assert all(r["slot"] == slots[(r["source"], r["block"])] for r in got)
        assert all(r["position"] == r["slot"] * size + r["rank"] % size for r in got)


def test_a_written_mixture_keeps_its_order(spark, tmp_path):
    rows = [(k, "x" * (1 + 4000 * (k % 2)), "hot" if k % 3 else f"s{k % 7}", 5) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, position int")
    mixed = mixing.mix(docs.repartition(5), block_rows=4)
    path = str(tmp_path / "mixed")
    mixed.repartitionByRange(6, F.monotonically_increasing_id()).write.parquet(path)
    back = common.placed(spark.read.parquet(path), "position").collect()
    assert sorted(r["position"] for r in back) == list(range(900))
    ids = [r["doc_id"] for r in sorted(back, key=lambda r: r["position"])]
    assert ids == [r["doc_id"] for r in mixed.collect()] and ids != [r["doc_id"] for r in spark.read.parquet(path).collect()]
    assert [r["position"] for r in common.placed(docs.orderBy("doc_id"), "position").select("position").collect()] != [5] * 900


def test_mix_keeps_all_rows_and_their_columns(spark):
    rows = [(k % 50, f"text {k % 50}", None if k % 7 == 0 else f"s{k % 50 % 3}", "p") for k in range(120)] + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, position string")
    mixed = mixing.mix(docs, block_rows=4)
    assert mixed.columns == docs.columns

    def key(r):
        return tuple((v is None, v) for v in r)

    assert sorted(map(tuple, mixed.collect()), key=key) == sorted(rows, key=key)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_unnamed_sources_are_an_error(spark):
    keys = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(Exception, match="no weight for source b"):
        mixing.schedule(keys, ["doc_id"], {"a": 1.0}).collect()


MODEL = sentencepiece.PieceModel.from_file(sentencepiece.MODEL_PATH)
TEXTS = ["", " ", "  two  spaces ", "Hello world", "Thwh erst. Éréré", "▁mark ▁▁", "😀 \x00\n\t tabs", "a" * 5000, "中文 字", "x▁y",
         "<s> </s> <unk> <0x41>", " nbsp"]


def plain_score(text, model):
    """The best score of a marked text, by trying every piece at every position."""
    pieces = {piece: model.scores[k] for k, piece in enumerate(model.pieces) if model.usable[k]}
    longest = max(map(len, pieces))
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            if text[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[text[start:end]])
        if best[end] == -math.inf:
            best[end] = best[end - 1] + model.byte_score * len(text[end - 1].encode())
    return best[-1]


@pytest.mark.parametrize("text", [t for t in TEXTS if t and "▁" not in t and len(t) < 100])
def test_viterbi_finds_the_best_score(text):
    ids = sentencepiece.encode_text(text, MODEL)
    got = sum(MODEL.byte_score if k < MODEL.bytes_at + 256 and k >= MODEL.bytes_at else MODEL.scores[k] for k in ids)
    assert got == pytest.approx(plain_score("▁" + text.replace(" ", "▁"), MODEL))


def test_ids_decode_to_the_text(spark):
    rows = [(k, text, "i") for k, text in enumerate([*TEXTS, None])] + [(0, "", "i"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = sentencepiece.encode(docs, MODEL)
    assert coded.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip"]
    got = sentencepiece.decode(coded, MODEL).collect()
    assert len(got) == len(rows)
    for row in got:
        if row["text"] is None:
            assert row["ids"] is None and row["n_tokens"] is None and row["round_trip"] is None and row["decoded"] is None
        else:
            assert row["round_trip"] and row["decoded"] == row["text"] and row["n_tokens"] == len(row["ids"])
    assert sentencepiece.encode(docs.limit(0), MODEL).collect() == []


def test_the_library_decodes_our_ids_alike():
    import sentencepiece as library
    file = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_PATH)
    for text in TEXTS:
        if "\x00" not in text:
            assert file.decode(list(sentencepiece.encode_text(text, MODEL))) == text


def brute(rows, k):
    out = []
    usable = [(i, np.floor(1024 * np.asarray(v, dtype=np.float64)).astype(np.int64)) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for own, q in usable:
        if own % 100 == 0:
            best = sorted(((-int(q @ v), i) for i, v in usable if i != own and len(v) == len(q)))[:k]
            out += [(own, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [10_000, 97])
def test_top_k_equals_brute_force(spark, shard_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12))
    rows = [(k, [float(x) for x in np.float32(centres[k % 8] + 0.2 * rng.normal(size=12))]) for k in range(900)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)]  # one common vector, so ties
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (None, rows[1][1]),
             (2100, [0.0] * 12), (2101, [1.0, 2.0]), (2200, [3.0, -1.0]), (2300, []), (2400, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = mtree.integer_vectors(table)
    got = mtree.top_k(vectors, vectors.filter("id % 100 = 0"), 10, shard_rows=shard_rows, query_rows=5, page_entries=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)
    nothing = vectors.limit(0)
    assert mtree.top_k(nothing, nothing).collect() == []


def test_pages_are_pruned(monkeypatch):
    rng = np.random.default_rng(6)
    values = (1024 * (np.repeat(np.eye(16), 200, axis=0) + 0.01 * rng.normal(size=(3200, 16)))).astype(np.int64)
    root = mtree.build(mtree.lifted(values))
    met = []
    plain = mtree._products

    def counted(values, queries):
        product = plain(values, queries)
        return lambda asked, rows: met.append(len(asked) * len(rows)) or product(asked, rows)

    monkeypatch.setattr(mtree, "_products", counted)
    ids = np.arange(3200)
    at, scores, best = mtree.search(root, values, ids, values[:1], ids[:1], 5)
    assert sum(met) < 3200
    plain_scores = values[1:] @ values[0]
    order = np.lexsort((ids[1:], -plain_scores))[:5]
    assert best.tolist() == ids[1:][order].tolist() and scores.tolist() == plain_scores[order].tolist()


@pytest.mark.parametrize("size", [1, 1 << 24, 3_000_000_000])
def test_waves_find_what_all_products_give(size):
    rng = np.random.default_rng(size % 97)
    values = rng.integers(-size, size + 1, size=(700, 5))
    values[100:300] = values[100]
    if size > 1 << 30:
        values //= 4
    ids = rng.permutation(700)
    root = mtree.build(mtree.lifted(values), page_entries=8)
    asked = np.arange(0, 700, 9)
    at, scores, best = mtree.search(root, values, ids, values[asked], ids[asked], 7)
    for n, row in enumerate(asked.tolist()):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(values[row], other, strict=True)), int(key))
                       for key, other in zip(ids, values, strict=True) if key != ids[row])[:7]
        assert [(-int(score), int(key)) for score, key in zip(scores[at == n], best[at == n], strict=True)] == exact


def test_a_score_beyond_64_bits_is_an_error():
    values = np.full((3, 4), 1 << 31, dtype=np.int64) * 4
    with pytest.raises(OverflowError):
        mtree.search(mtree.build(mtree.lifted(values)), values, np.arange(3), values, np.arange(3), 2)
