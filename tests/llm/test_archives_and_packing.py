"""Archives by exact round trips, decontamination and packing by brute force, the pipeline by its parts."""

import base64
import hashlib
import math
import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import LOWER, WORD, awkward, empty, labels  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from setstride.llm import decontaminate, packing, warc
from setstride.llm.tokens import WordTokenizer

PAGES = [
    (1, "http://a.example/x y", "<p>é</p>"), (2, None, None), (3, "http://b.example/", "<p>é</p>"), (4, "", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (5, "u", "filedesc://x 1 2 3 4\n"), (6, "u", ""), (7, "u", "x" * 300_000), (8, "\n\t", "\n\n\n"), (9, "u", "<p>é</p>"), (None, "n", "no id"),
]


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pages_round_trip_through_both_archive_forms(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    got = {r["page_id"]: r for r in warc.page_records(pages).collect()}
    assert len(got) == len(PAGES)
    data = {i: (h or "").encode() for i, _, h in PAGES}
    for i, payload in data.items():
        group = [j for j in data if data[j] == payload]
        last = max(group, key=lambda j: -1 if j is None else j)
        kind = ("response", None) if i == last else ("revisit", last)
        assert (got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["record_type"], got[i]["refers_to"]) == (len(payload), sha(payload), *kind)
    folder = f"{tmp_path}/warc"
    warc.archive(pages, folder)
    records = warc.read_warc(spark, folder).collect()
    assert {r["page_id"]: bytes(r["payload"]) for r in records if r["type"] == "response"} == {i: data[i] for i, r in got.items() if r["record_type"] == "response"}
    assert len({r["record_id"] for r in records}) == len(PAGES) and all(uuid.UUID(r["record_id"].removeprefix("urn:uuid:")) for r in records)
    assert {r["date"] for r in records} == {"2020-01-01T00:00:00Z"}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_is_read_by_declared_lengths(version):
    payloads = [b"", b"a\nb\n\nhttp://x 0.0.0.0 20200101000000 text/html 5\nabcde", bytes(range(256)), b"\n\n"]
    block = warc.arc_version_block(version, "t.arc")
    for n, p in enumerate(payloads):
        block += warc.arc_record(version, len(block), "t.arc", str(n), f"http://x/{n} b", p)
    read = list(warc.parse_arc(block))
    assert [r["payload"] for r in read] == payloads
    assert [r["Archive-length"] for r in read] == [str(len(p)) for p in payloads]
    with pytest.raises(ValueError):
        list(warc.parse_arc(block[:-3]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"filedesc://t 0 0 text/plain 9\n7 0 x\nA B\n"))


def test_empty_archive(spark):
    assert warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_tiles(item, doc, least):
    """Greedy tiling by looking at every common run each time."""
    a, b, total = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and a[i + n] and b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        a[i : i + n], b[j : j + n] = [False] * n, [False] * n
        total += n


def test_tiling_covers_what_brute_force_covers():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 24))]
        doc = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(item))
            doc[rng.randrange(len(doc) + 1) : 0] = item[i : i + rng.randint(1, 12)]
        least = rng.randint(1, 5)
        found = decontaminate.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), least)
        for i, j, n in found:
            assert item[i : i + n] == doc[j : j + n] and n >= least
        for side, size in ((0, len(item)), (1, len(doc))):
            marked = np.zeros(size, int)
            for t in found:
                marked[t[side] : t[side] + t[2]] += 1
            assert marked.max(initial=0) <= 1
        assert abs(sum(t[2] for t in found) - brute_tiles(item, doc, least)) <= least


def test_contaminated_documents(spark, awkward, empty):  # noqa: F811
    rng = random.Random(8)
    items = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(rng.randint(8, 50))) for _ in range(20)] + ["tiny item", None, "", "  "]
    rest = lambda n: " ".join(f"r{rng.randrange(10**6)}" for _ in range(n))
    docs = [rest(30), None, "", f"{rest(40)} {items[3].upper()} {rest(9)}", items[5], " ".join(items[7].split()[: len(items[7].split()) // 3]), "a TINY\titem here"]
    half = items[9].split()
    docs.append(" ".join([*half[len(half) // 2 :], rest(20), *half[: len(half) // 2]]))
    docs += [docs[3]] * 40
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(3, items[3])], "item_id long, text string")
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(2)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(rows, bench).collect()}
    assert found == {(3, 3), (4, 5), (6, 20), (7, 9)} | {(8 + n, 3) for n in range(40)}
    clean = decontaminate.clean(rows, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 2, 5]
    assert decontaminate.clean(awkward, bench).count() == awkward.count()
    assert decontaminate.clean(awkward, bench).columns == awkward.columns
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(rows, bench.limit(0)).count() == 0


PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's don't 'tis I'LL 12 a1b2 × ÷ ÀÉß ÿ a\x0bb\x0c</w> x</w>y !!'s ''re", "<|endoftext|> a", "İstanbul Σας", "", "   ", "\x1c a\xa0b", "naïve café’s", "achß. 𝒜😀 é"]


def test_word_tokenizer_equals_the_tokenizer(awkward):  # noqa: F811
    texts = ODD + [r["text"] or "" for r in awkward.select("text").collect()]
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, WordTokenizer(PATH).encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text[:50]


def test_foreign_arc_files_of_both_versions(spark, tmp_path):
    """Records that another writer made: blanks in URLs, HTTP heads, addresses, no page ids."""
    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"
    bodies = [b"<html>Hello World!!!</html>", b"same\n\n", b"same\n\n"]
    for version in (1, 2):
        body = f"{version} 0 Alexa Internet\n{warc.ARC_FIELDS[version]}\n".encode()
        tail = "" if version == 1 else "200 - - 0 old.arc "
        data = f"filedesc://old-{version}.arc 0.0.0.0 19960923142103 text/plain {tail}{len(body)}\n".encode() + body + b"\n"
        for url, ip, date, payload in zip(("http://www.dryswamp.edu:80/index.html", "http://a b/x#page=3", "http://c/"), ("127.10.100.2", "10.0.0.1", "10.0.0.2"), ("19961104142103", "199611", "19961104142104"), bodies):
            data += f"{url} {ip} {date} text/html {tail}{len(http + payload)}\n".encode() + http + payload + b"\n"
        (tmp_path / f"old-{version}.arc").write_bytes(data)
    records = warc.convert(warc.read_arc(spark, str(tmp_path))).collect()
    assert len(records) == 6 and len({r["record_id"] for r in records}) == 6 and all(r["page_id"] is None for r in records)
    assert {bytes(r["payload"]) for r in records} == set(bodies) and {bytes(r["head"]) for r in records} == {http}
    assert {r["date"] for r in records} == {"1996-11-04T14:21:03Z", "1996-11-00T00:00:00Z", "1996-11-04T14:21:04Z"}
    warc.write_warc(warc.with_references(warc.convert(warc.read_arc(spark, str(tmp_path)))), str(tmp_path / "warc"))
    back = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(r["type"] for r in back) == ["response"] * 2 + ["revisit"] * 4
    assert {(r["payload_digest"], r["payload_bytes"]) for r in back} == {(sha(b), len(b)) for b in bodies}
    text = spark.read.text(str(tmp_path / "warc")).collect()
    assert any(r["value"].startswith("WARC-IP-Address: 127.10.100.2") for r in text)


def test_repeated_pages_are_one_response(spark):
    pages = spark.createDataFrame([(1, "u", "x")] * 3 + [(2, "v", "y")], "page_id long, url string, html string").repartition(3)
    rows = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.page_records(pages).collect()), key=str)
    assert [r[:2] for r in rows] == [(1, "response"), (1, "revisit"), (1, "revisit"), (2, "response")] and rows[1][2] == 1


def test_packing_of_lengths():
    rng = random.Random(4)
    for n, low, high in ((400, 1, 100), (300, 17, 46), (60, 30, 60), (0, 1, 2)):
        lengths = [rng.randint(low, high) for _ in range(n)]
        first, bins = packing.best_fit(lengths, 100), packing.pack(lengths, 100)
        assert sorted(p for b in bins for p in b) == list(range(n))
        assert all(sum(lengths[p] for p in b) <= 100 for b in bins)
        assert math.ceil(sum(lengths) / 100) <= len(bins) <= len(first)


def test_local_search_exchanges():
    """Best fit needs three sequences for these; exchanges find two."""
    lengths = [50, 30, 25, 25, 40, 30]
    assert len(packing.best_fit(lengths, 100)) == 3 and len(packing.pack(lengths, 100)) == 2


def test_packed_pieces(spark, awkward, empty):  # noqa: F811
    most = 64
    found = packing.packed(awkward, PATH, most).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for r in awkward.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(str(r["doc_id"]), i, s, len(ids[s : s + most]), zlib.crc32(ids[s : s + most].tobytes())) for i, s in enumerate(range(0, len(ids), most))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(expected)
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= most
    assert packing.packed(empty, PATH).count() == 0


def test_pipeline_stages(spark, awkward, labels, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    awkward.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, " ".join(f"line{i}" for i in range(100, 140)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "sequence_packing":
            assert out.columns == awkward.columns
            before, docs = docs, corpus_pipeline.stored(out, name)
            assert docs.count() <= before.count()
            seen.append({r["doc_id"] for r in docs.collect()})
    assert seen[0] >= seen[1] >= seen[2] == seen[3]
    long_text = next(r["doc_id"] for r in awkward.collect() if (r["text"] or "").startswith("line0"))
    assert long_text not in seen[2]
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == seen[3]
    assert not re.search("limit|sample", " ".join(n for n, _ in corpus_pipeline.STAGES))


@pytest.mark.parametrize("low,high", [(27, 50), (22, 37), (30, 36)])
def test_search_goes_on_until_no_bin_can_give(low, high):
    """Against plain trying of every exchange between every two underfull bins."""
    rng = random.Random(low)
    lengths = [rng.randint(low, high) for _ in range(120)]
    bins = packing.pack(lengths, 100)
    held = [sorted(lengths[p] for p in b) for b in bins]
    if len(bins) == math.ceil(sum(lengths) / 100):
        return
    for i, a in enumerate(held):
        for j, b in enumerate(held):
            if i == j or sum(a) == 100 or sum(b) == 100:
                continue
            gifts = [(g, t) for g in map(sum, [[x] for x in a] + [[x, y] for x, y in zip(a, a[1:])]) for t in [0, *b]] + [(g, x + y) for g in a for n, x in enumerate(b) for y in b[n + 1 :]]
            assert not any(0 < g - t <= 100 - sum(b) and sum(b) + g - t > sum(a) for g, t in gifts if (g in a or t in [*b]))


def test_search_finds_what_best_fit_misses():
    rng = random.Random(1)
    lengths = [rng.randint(1100, 2050) for _ in range(3000)]
    assert len(packing.best_fit(lengths, 4096)) == 1297 and len(packing.pack(lengths, 4096)) <= 1265
