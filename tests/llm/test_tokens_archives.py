"""BPE against the tokenizers library, archives against zipfile and hashlib, URLs against a plain model."""

import base64
import gzip
import hashlib
import io
import json
import math
import random
import re
import zipfile
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foretell.llm import archive, bpe, url_filter


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_is_the_library_s(frame, text, theirs):
    rng = random.Random(1)
    texts = [
        None, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "x" * 3000, "ab" * 700, "\n\n \t a  b", "it's we'll I'M", "ñandú été 東京 🙂 é",
        text(1, 2000), "\x00\x1c\x85\u2028 end", *["".join(rng.choice("abcdet hin'\n 12!?éñß") for _ in range(rng.randrange(120))) for _ in range(80)],
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, "again"), (None, "again")]
    docs = frame(rows, "doc_id long, text string").drop("ids")
    out = bpe.round_trip(docs).collect()
    assert len(out) == len(rows) and bpe.round_trip(docs).columns == [*docs.columns, "ids", "decoded"]
    for row in out:
        whole = row.text or ""
        assert bpe.unpack(row.ids).tolist() == theirs.encode(whole, add_special_tokens=False).ids
        assert row.decoded == theirs.decode(bpe.unpack(row.ids).tolist(), skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs)).select("doc_id", "ids", "decoded")
    assert again.exceptAll(bpe.round_trip(docs).select("doc_id", "ids", "decoded")).count() == 0
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_bpe_decodes_any_ids(theirs):
    tokenizer = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    for seed in range(40):
        ids = np.random.default_rng(seed).integers(0, 50257, 20)
        assert tokenizer.decode(ids.astype("<u4").tobytes()) == theirs.decode(ids.tolist(), skip_special_tokens=False)


def test_bpe_cache_is_bounded(monkeypatch, text):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    tokenizer = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))
    parts = [tokenizer.encode([text(k, 30)])[0] for k in range(5)]
    assert len(tokenizer.cache) <= 80 and [tokenizer.decode(p) for p in parts] == [text(k, 30) for k in range(5)]


def expected_records(rows, least):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    largest = defaultdict(lambda: -math.inf)
    for i, p in payload:
        largest[p] = max(largest[p], -math.inf if i is None else i)
    out = []
    for i, p in payload:
        own = len(p) < least or (-math.inf if i is None else i) == largest[p]
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if own else "revisit", None if own else largest[p]))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a.example/", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (3, None, None), (4, "http://b.example/\r\nx", ""), (5, "ü", "<p>é</p>" * 5000),
    (9, "http://c.example/", "<p>one</p>"), (9, "http://c.example/again", "<p>one</p>"), (None, "http://n.example/", "<p>one</p>"), (6, "u", "line\r\n\r\nbreaks"),
]


@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("package_bytes", [1, 64 << 20])
def test_pages_come_back_from_packages(spark, frame, tmp_path, least, package_bytes):
    pages = frame(PAGES, "page_id long, url string, html string")
    packages = archive.write_packages(archive.page_records(pages, least_revisit_bytes=least), f"file://{tmp_path}", package_bytes=package_bytes)
    assert packages.agg(F.sum("records")).first()[0] == len(PAGES)
    found = archive.read_records(archive.read_index(packages)).collect()
    number = lambda name: int(name.rpartition(":")[2]) if name and name[-1] != ":" else None
    got = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found]
    assert sorted(got, key=str) == expected_records(PAGES, least)
    assert {r.payload.decode() for r in found if r.payload is not None} == {h or "" for _, _, h in PAGES}


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    packages = archive.write_packages(archive.page_records(none), f"file://{tmp_path}")
    assert packages.count() == 0 and archive.read_records(archive.read_index(packages)).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_directories(monkeypatch, wide):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for k in range(6):
            z.writestr(zipfile.ZipInfo(f"archive/m{k}"), bytes([65 + k]) * (30 + k * 20))
        z.writestr("packed", b"x" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 not the end"
    data = raw.getvalue()
    assert (b"PK\6\6" in data) == wide
    read = lambda n, at: data[at : at + n]
    members = {m.name: m for m in archive.read_directory(read, len(data))}
    assert len(members) == 7
    for k in range(6):
        m = members[f"archive/m{k}"]
        assert read(m.size, archive.data_offset(read, m)) == bytes([65 + k]) * (30 + k * 20)
    with pytest.raises(ValueError, match="compressed"):
        archive.data_offset(read, members["packed"])
    with pytest.raises(ValueError, match="not a ZIP"):
        archive.read_directory(lambda n, at: b"nothing"[at : at + n], 7)


def test_a_package_without_index_is_scanned(spark, tmp_path):
    rows = [{"record_type": "response", "record_id": f"urn:page:{k}", "date": "2024-01-01T00:00:00Z", "target_uri": "u", "refers_to": None,
             "payload": b"x" * k * 40_000, "payload_bytes": k * 40_000, "sha1": hashlib.sha1(b"x" * k * 40_000).hexdigest()} for k in range(4)]
    with zipfile.ZipFile(tmp_path / "p.wacz", "w") as z:
        z.writestr(archive.RECORDS_MEMBER, b"".join(map(archive.pack_record, rows)))
    found = archive.read_records(archive.read_index(archive.packages_at(spark, [f"file://{tmp_path}/p.wacz"]))).collect()
    assert sorted((r.record_id, r.payload_bytes) for r in found) == [(f"urn:page:{k}", k * 40_000) for k in range(4)]


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]


def plain_rule(url):
    rest = (url or "").split("://", 1)
    host, path = "", ""
    if len(rest) == 2:
        host = re.split("[/?#]", rest[1])[0]
        path = re.split("[?#]", rest[1][len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, says in RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = (rule, says)
    return host, path, best


def ratio(url, counted, order):
    """Witten-Bell, straight from its definition."""
    counts = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}

    def places(u):
        padded = "\u0002" * order + u + "\u0003"
        return [(padded[i : i + order], padded[i + order]) for i in range(len(u) + 1)]

    for u, says in counted:
        for context, c in places(u):
            for k in range(order + 1):
                counts[says][context[order - k :]][c] += 1

    def log_p(says, context, c):
        p = 1 / url_filter.ALPHABET
        for k in range(order + 1):
            seen = counts[says].get(context[order - k :])
            if seen:
                p = (seen[c] + len(seen) * p) / (seen.total() + len(seen))
        return math.log(p)

    return np.mean([log_p("allow", *x) - log_p("block", *x) for x in places(url)])


def test_urls_against_a_plain_model(spark, frame):
    rng = random.Random(2)
    hosts = ["news.example.com", "www.example.com", "shop.org", "EXAMPLE.com", "casa.net", "sub.casa.net", "other.net"]
    urls = [f"http{'s' * rng.randrange(2)}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr'])}/{rng.randrange(50)}" for _ in range(120)]
    urls += [None, "", "no scheme", "http://", "x://y.com?q=/en/", "x://y.com/#/", "ftp://a.com:80/", "http://ü.net/es/ñ🙂", *urls[:10]]
    pages = frame(list(enumerate(urls)), "page_id long, url string")
    out = {r.page_id: r for r in url_filter.filter_urls(pages, RULES, order=3).collect()}
    assert len(out) == len(urls)
    distinct = spark.createDataFrame([(u or "",) for u in set(urls)], "url string").distinct()
    held = {r.url for r in distinct.where(F.pmod(F.xxhash64("url"), F.lit(url_filter.HELD_OUT)) == 0).collect()}
    judged = {u or "": plain_rule(u) for u in urls}
    counted = [(u, best[1]) for u, (_, _, best) in judged.items() if best and u not in held]
    for k, u in enumerate(urls):
        host, path, best = plain_rule(u)
        row = out[k]
        assert (row.host, row.path, row.rule) == (host, path, best and best[0])
        if best:
            assert row.verdict == best[1] and row.ratio is None
        else:
            assert row.ratio == pytest.approx(ratio(re.sub("[^\x00-\uffff]", "�", u or ""), counted, 3), abs=1e-9)
            assert row.verdict == ("allow" if row.probability >= 0.5 else "block")


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    row = url_filter.filter_urls(pages, RULES).first()
    assert (row.ratio, row.probability, row.verdict) == (0.0, 0.5, "allow")
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_packages_of_other_tools(spark, tmp_path):
    def record(name, payload, gz=True, kind="response", digest=True):
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + payload if kind == "response" else payload
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"Content-Length: {len(body)}"]
        head += ["Content-Type: application/http; msgtype=response"] if kind == "response" else ["Content-Type: application/warc-fields"]
        head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"] if digest else []
        data = ("\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"
        return gzip.compress(data) if gz else data

    named, unnamed = [record(f"b{k}", b"named %d" % k) for k in range(3)], [record(f"c{k}", b"unnamed %d" % k) for k in range(2)]
    plain = [record("a0", b"x" * 5000, gz=False), record("a1", b"", gz=False), record("info", b"software: test", gz=False, kind="warcinfo", digest=False)]
    at = np.cumsum([0] + [len(r) for r in named]).tolist()
    lines = [f"com,x)/ 2024 {json.dumps({'filename': 'b.warc.gz', 'offset': str(o), 'length': str(len(r))})}" for o, r in zip(at, named)]

    def package(path, index, method=zipfile.ZIP_STORED, twice=False):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("archive/a.warc", b"".join(plain), compress_type=method)
            z.writestr("archive/b.warc.gz", b"".join(named))
            z.writestr("archive/c.warc.gz", b"".join(unnamed))
            if twice:
                z.writestr("archive/c.warc.gz", b"")
            z.writestr("indexes/index.cdxj", "\n".join(index))
        return archive.packages_at(spark, [str(path)])

    got = archive.read_records(archive.read_index(package(tmp_path / "one.wacz", ["", *lines, ""]))).collect()
    assert sorted(r.record_id for r in got) == ["a0", "a1", "b0", "b1", "b2", "c0", "c1", "info"]
    rows = {r.record_id: r for r in got}
    assert rows["a0"].payload == b"x" * 5000 and rows["a1"].payload_bytes == 0 and rows["b2"].payload == b"named 2" and rows["c1"].payload == b"unnamed 1"
    assert rows["info"].payload == b"software: test" and rows["info"].payload_digest is None and rows["info"].record_type == "warcinfo"
    for name, wrong in (
        ("two", package(tmp_path / "two.wacz", [lines[0].replace("b.warc", "z.warc")])),
        ("three", package(tmp_path / "three.wacz", lines, zipfile.ZIP_DEFLATED)),
        ("four", package(tmp_path / "four.wacz", lines, twice=True)),
    ):
        with pytest.raises(Exception, match="no archive of the package|only stored members|two members"):
            archive.read_index(wrong).collect()
    with pytest.raises(ValueError, match="cut off"):
        list(archive._scan_plain(lambda n, o: plain[0][o : o + n], 0, len(plain[0]) - 40))
    with pytest.raises(ValueError, match="without warc-type"):
        archive.parse_record(b"WARC/1.0\r\nWARC-Record-ID: <x>\r\nContent-Length: 0\r\n\r\n")


def test_reading_is_spread_by_bytes_of_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "LEAST_TASK_BYTES", 2000)
    monkeypatch.setattr(archive, "RANGE_BYTES", 500)
    rng = random.Random(3)
    rows = [(k, f"https://x.com/{k}", "".join(rng.choice("abcdefghij ") for _ in range(400))) for k in range(60)]
    records = archive.page_records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = archive.read_records(archive.read_index(archive.write_packages(records, f"{tmp_path}/p")))
    assert found.count() == 60 and found.select(F.spark_partition_id()).distinct().count() > 1
