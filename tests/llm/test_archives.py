import glob
import gzip
import hashlib
import os

import pytest

from conftest import rows
from llm_data import SF, llm  # noqa: F401
from tillbook.llm import archives as ar
from tillbook.session import new_folder

NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
LONG = "<p>é漢" + "x" * 1200 + "</p>"
SHORT = "<p>short</p>"
PAGES = [
    (1, "http://a.example/1", LONG),
    (2, "http://a.example/2", LONG),
    (9, None, LONG),
    (None, "http://a.example/none", LONG),
    (3, "http://a.example/with space\tand tab", SHORT),
    (4, "http://a.example/4", SHORT),
    (5, "http://a.example/5", None),
    (6, "", ""),
    (7, "http://a.example/7", "a" * 999 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (8, "http://a.example/8", "b" * 100_000),
    (8, "http://a.example/8", "b" * 100_000),
    (10, "http://a.example/10", "c" * 999),
    (11, "http://a.example/11", "c" * 999),
    (12, "http://a.example/12", "HTTP/1.1 404 Not Found\n\nfiledesc://x 0.0.0.0 1 text/plain 3\n"),
]
SCHEMA = "page_id long, url string, html string"


def brute(pages, least=1000):
    found = [(i, u, (h or "").encode()) for i, u, h in pages]
    best = {}
    for i, _, h in found:
        if len(h) >= least and (h not in best or (i is not None and (best[h] is None or i > best[h]))):
            best[h] = i
    taken, out = set(), []
    for i, u, h in sorted(found, key=lambda r: repr(r)):
        copy = len(h) >= least and (i != best[h] or h in taken)
        taken |= {h} if len(h) >= least and i == best[h] else set()
        url = (u or "").replace(" ", "%20").replace("\t", "%09") or None
        out.append((i, url, len(h), hashlib.sha1(h).hexdigest(), "revisit" if copy else "response", best[h] if copy else None))
    return sorted(out, key=repr)


def df_of(llm, pages):  # noqa: F811
    return llm.createDataFrame([(*p, "d", 1, "k") for p in pages], SCHEMA + ", digest string, offset int, kind string")


@pytest.mark.parametrize("archive_bytes", [1, 4000, ar.ARCHIVE_BYTES])
def test_pages_survive_both_formats(llm, archive_bytes):  # noqa: F811
    found = ar.round_trip(df_of(llm, PAGES).repartition(3), archive_bytes=archive_bytes)
    assert rows(found, *NAMES) == brute(PAGES)


def test_owners_by_shuffle(llm, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ar, "broadcast_if_small", lambda df: df)
    assert rows(ar.round_trip(df_of(llm, PAGES)), *NAMES) == brute(PAGES)


def test_table_equals_its_statement(llm):  # noqa: F811
    pages = [tuple(r) for r in llm.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    want = [r[:1] + r[2:] for r in brute(pages)]
    from tillbook.llm import queries

    assert rows(queries.queries()["op13_archive_records"](llm, SF)) == sorted(want, key=repr)


def test_empty_table(llm):  # noqa: F811
    assert rows(ar.round_trip(df_of(llm, PAGES).limit(0))) == []


# ---------------------------------------------------------------- files as other programs write them
V1 = (
    b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 77\n1 0 AlexaInternet\nURL IP-address Archive-date Content-type Archive-length\n\n"
    b"\nhttp://www.dryswamp.edu:80/index.html 127.10.100.2 19961104142103 text/html 47\nHTTP/1.0 200 Document follows\r\nA: b\r\n\r\nHello\n\ny\n"
    b"dns:www.dryswamp.edu 127.0.0.1 19961104 text/dns 5\n1.2.3\n"
)
V2 = (
    b"filedesc://new.arc 0.0.0.0 19980923142103 text/plain 200 - - 0 new.arc 123\n2 0 AlexaInternet\n"
    b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n"
    b"\nhttp://x.example/a b 127.10.100.2 199809231421 text/html; charset=x 302 f00 http://y.example/ 209 new.arc 28\nHTTP/1.0 302 Moved\r\n\r\nMoved.\n"
)


def fixed_lengths(raw: bytes) -> bytes:
    """The version block's declared length set to what its two or three lines take."""
    head, rest = raw.split(b"\n", 1)
    size = rest.index(b"\n\n") + 2
    return head.rsplit(b" ", 1)[0] + b" %d\n" % size + rest


def folder_with(spark, files):
    folder = new_folder(spark, "test-archives").removeprefix("file:")
    os.makedirs(folder)
    for name, content in files.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(content)
    return folder


def test_legacy_files_of_both_versions(llm):  # noqa: F811
    folder = folder_with(llm, {"old.arc": fixed_lengths(V1), "new.arc.gz": gzip.compress(fixed_lengths(V2))})
    found = rows(ar.read_arcs(llm, folder), "version", "url", "date", "kind", "page_id", "payload_bytes", "digest")
    sha = lambda b: hashlib.sha1(b).hexdigest()
    assert found == [
        (1, "dns:www.dryswamp.edu", "19961104", "text/dns", None, 5, sha(b"1.2.3")),
        (1, "http://www.dryswamp.edu:80/index.html", "19961104142103", "text/html", None, 8, sha(b"Hello\n\ny")),
        (2, "http://x.example/a b", "199809231421", "text/html; charset=x", None, 6, sha(b"Moved.")),
    ]
    warcs = new_folder(llm, "test-warc")
    ar.convert(llm, folder, warcs)
    again = rows(ar.read_warcs(llm, warcs), "url", "date", "record_type", "payload_bytes")
    assert again == [
        ("dns:www.dryswamp.edu", "1996-11-04T00:00:00Z", "resource", 5),
        ("http://www.dryswamp.edu:80/index.html", "1996-11-04T14:21:03Z", "response", 8),
        ("http://x.example/a b", "1998-09-23T14:21:00Z", "response", 6),
    ]
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{warcs}/**/*.gz".removeprefix("file:"), recursive=True))
    ids = [line for line in text.split(b"\r\n") if line.startswith(b"WARC-Record-ID: <urn:uuid:")]
    assert len(set(ids)) == len(ids) >= 4  # with warcinfo


def test_bytes_that_are_no_text_survive(llm):  # noqa: F811
    body = bytes(range(256)) * 8
    block = b"HTTP/1.0 200 OK\r\n\r\n" + body
    raw = fixed_lengths(V1.split(b"\nhttp")[0] + b"\n") + b"http://b.example/ 1.1.1.1 20010101000000 image/png %d\n%s\n" % (len(block), block)
    warcs = new_folder(llm, "test-warc")
    ar.convert(llm, folder_with(llm, {"a.arc": raw}), warcs)
    assert rows(ar.read_warcs(llm, warcs), "payload_bytes", "digest") == [(2048, hashlib.sha1(body).hexdigest())]


@pytest.mark.parametrize("harm", [lambda b: b[:-20], lambda b: b.replace(b" 5\n1.2.3", b" 500\n1.2.3"), lambda b: b.replace(b"text/dns 5", b"text/dns five")])
def test_broken_archives_are_named(llm, harm):  # noqa: F811
    folder = folder_with(llm, {"bad.arc": harm(fixed_lengths(V1))})
    with pytest.raises(Exception, match="bad.arc"):
        ar.read_arcs(llm, folder).collect()


def test_changed_content_is_found(llm):  # noqa: F811
    value = ar.warc_lead("a", 1) + b"\r\n\r\n"
    good = {"record_id": "<urn:uuid:1>", "date": "2001", "url": "u", "ip": "1", "kind": "k", "digest": hashlib.sha1(b"body").hexdigest(), "payload_bytes": 4}
    value += ar.warc_record(good | {"block": b"HTTP/1.1 200 OK\r\n\r\nbody", "refers_to_id": None}, 1, "a", 0)
    assert ar.read_warcs(llm, folder_with(llm, {"a.warc": value})).count() == 1
    with pytest.raises(Exception, match="a.warc"):
        ar.read_warcs(llm, folder_with(llm, {"a.warc": value.replace(b"body", b"bodx")})).collect()


@pytest.mark.parametrize(
    "arc, warc",
    [
        ("19961104142103", "1996-11-04T14:21:03Z"),
        ("19961104142103123", "1996-11-04T14:21:03.123Z"),
        ("199611041421", "1996-11-04T14:21:00Z"),
        ("19961104", "1996-11-04T00:00:00Z"),
        ("1996", "1970-01-01T00:00:00Z"),
    ],
)
def test_dates(arc, warc):
    assert ar.warc_date(arc) == warc
