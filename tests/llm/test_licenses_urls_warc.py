import base64
import gzip
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from labelloom.llm import licenses, urls, warc
from tests.llm.helpers import SF, awkward_documents, empty_documents


def plain_scan(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    hits = 0
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == plain_scan(r.text)
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1
        hits += g.n_base
    assert hits > 0


@pytest.mark.parametrize(
    "text", ["", "mit license", "MIT LICENSE mit license license mit", "mit-license", "xmit license", "apache\nlicense.", "mit license mit", "é mit license"]
)
def test_base_edges(text):
    n, places, first, last, base, *_ = licenses.scan(text)
    assert (n, places, first, last, base) == plain_scan(text)


def spans(text):
    words = text.lower().encode().translate(licenses.WORD_BYTES).split()
    return [(label) for label, *_ in licenses.detect(b" " + b" ".join(words) + b" ")]


def test_rules_are_many_and_ordered():
    rules = licenses.rules()
    assert len(rules) > 250
    assert all(re.sub(rb"[^a-z0-9]", b"", r.keyword) == r.keyword for r in rules)
    assert spans("under the GNU Lesser General Public License, version 2.1 or later") == ["lgpl-2.1"]
    assert spans("licensed under the Apache License") == ["apache"]
    assert spans("Apache License, Version 2.0 and the MIT License") == ["apache-2.0", "mit"]
    assert spans("SPDX-License-Identifier: MIT") == ["mit"]
    assert spans("nothing to see") == []
    assert licenses.scan("GNU General Public License v3")[5] == "gpl,gpl-3"


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0"),
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd"),
        ("SPDX-License-Identifier: LGPL-2.1+", "lgpl-2.1"),
        ("Apache-2.0", "apache-2.0"),
        ("GPL-2.0-or-later", "gpl-2.0"),
        ("under GPLv3 now", "gpl-3"),
        ("LGPLv2.1+ code", "lgpl-2.1"),
        ("Licensed under MIT", "mit"),
        ("released under the Apache 2.0", "apache-2.0"),
        ("distributed under the terms of the BSD", "bsd"),
        ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0"),
        ("Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported", "cc-by-nc-nd-3.0"),
        ("Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
        ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
        ("https://opensource.org/licenses/MIT", "mit"),
        ("http://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"),
        ("http://mozilla.org/MPL/2.0/", "mpl-2.0"),
        ("http://www.boost.org/LICENSE_1_0.txt", "bsl-1.0"),
        ("https://creativecommons.org/publicdomain/zero/1.0/", "cc0-1.0"),
        ("commit to the apache tribe and mix 2 of 3", ""),
        ("the gplv0 and mitten", ""),
    ],
)
def test_ways_of_naming(text, labels):
    assert ",".join(sorted(set(spans(text)))) == labels


def plain_detect(line):
    """All rules without a prefilter, each detection against all kept ones."""
    hits = [(r.priority, m.end() - m.start(), -i, m.start(), m.end()) for i, r in enumerate(licenses.rules()) for m in r.pattern.finditer(line)]
    kept = []
    for _, _, order, a, b in sorted(hits, reverse=True):
        if not any(a < y and x < b for x, y, _ in kept):
            kept.append((a, b, -order))
    return [(licenses.rules()[i].label, a, b, licenses.rules()[i].weight) for a, b, i in sorted(kept)]


def test_detections_match_the_plain_version(spark):
    rnd = random.Random(6)
    words = sorted({w for r in licenses.rules() for w in re.findall("[a-z0-9]+", r.pattern.pattern.decode())})
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    texts += [" ".join(rnd.choice(words) for _ in range(200)) for _ in range(50)]
    names = [n for _, group, _ in licenses.FAMILIES for n in group] + ["version 2 0", "v3", "or later", "licensed under the terms of the", "spdx license identifier", "cc by 4 0"]
    texts += [" ".join(rnd.choice(names) for _ in range(40)) for _ in range(100)]
    found = 0
    for text in texts:
        line = b" " + b" ".join(text.encode().translate(licenses.WORD_BYTES).split()) + b" "
        assert licenses.detect(line) == plain_detect(line)
        found += len(licenses.detect(line))
    assert found > 1000


def test_very_many_detections_take_linear_time():
    import time

    licenses.scan("warm up")
    start = time.perf_counter()
    n, places, first, last, base, labels, _ = licenses.scan("mit license and " * 100_000)
    assert (n, places, first, last, base, labels) == (300_000, 100_000, 0, 299_997, "mit", "mit")
    assert time.perf_counter() - start < 3


def test_prefilter_loses_nothing(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        line = b" " + b" ".join(r.text.encode().translate(licenses.WORD_BYTES).split()) + b" "
        hits = {rule.label for rule in licenses.rules() if rule.pattern.search(line)}
        assert bool(hits) == bool(licenses.detect(line))


def test_awkward_documents(spark):
    rows = {r.doc_id: r for r in licenses.license_scan(awkward_documents(spark)).collect()}
    assert rows[3].n_words == 0 and rows[3].first_word is None and rows[3].labels == ""
    assert rows[8].base_labels == "apache,gpl,mit" and rows[8].first_word == 1
    assert licenses.license_scan(empty_documents(spark)).count() == 0
    assert licenses.license_spans(awkward_documents(spark)).filter("doc_id = 7").count() == 2


# --- urls ---


def plain_rule(host, path):
    best = None
    for verdict, on, below in urls.RULES:
        if (host == on or host.endswith("." + on)) and path.startswith(below):
            if best is None or len(on + below) > len(best[0]):
                best = (on + below, verdict)
    return best or (None, None)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http://A.Example.COM", "HTTPS://www.Example.com/en/x?y#z", "http://com/", "http://xcom/",
    "http://a.net/es/1", "http://net/fr/", "http://a.net?/es/", "http://a.net#/es/", "x://y://z.com/en/", "http://É.com/É", "http://example.com/en/",
    "http://example.com/en", "http://a\nb.com/c\nd", "http://.com/",
]


def pages(spark, values, html="<p>some words for the counts</p>"):
    return spark.createDataFrame([(i, u, html, "h", 1, "v") for i, u in enumerate(values)], "page_id bigint, url string, html string, host string, n int, verdict string")


def test_rules_match_brute_force(spark):
    table = pages(spark, ODD_URLS + ODD_URLS[:8])
    got = {r.page_id: r for r in urls.judge_urls(table).collect()}
    assert len(got) == table.count()
    for r in table.collect():
        host, path = plain_parts(r.url)
        rule, verdict = plain_rule(host, path)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule), r.url
        assert g.verdict == verdict if verdict else g.verdict in ("allow", "block")


def test_small_table_and_empty_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in urls.judge_urls(table).collect()}
    for r in table.collect():
        assert (got[r.page_id].rule,) == plain_rule(*plain_parts(r.url))[:1]
    assert urls.judge_urls(table.limit(0)).count() == 0


def test_names_are_cut_into_words(spark):
    table = pages(spark, ["http://greenteahouse.com/"], "<b>green</b> " + "green tea house " * 9 + "greent eahouse zz")
    counts = urls.word_counts(table)
    runs = spark.createDataFrame([("greenteahouse",), ("teaqqhouse",), ("x",)], "run string")
    got = {r.run: r.words for r in urls.segment_runs(runs, counts).collect()}
    assert got["greenteahouse"] == ["green", "tea", "house"]
    assert got["teaqqhouse"] == ["tea", "qq", "house"] and got["x"] == ["x"]


def test_best_cut_matches_all_cuts():
    import itertools
    import math

    known = {"ab": 5, "a": 9, "b": 2, "abc": 3, "cd": 4, "d": 8}

    def cost(word):
        return math.log(known[word]) - math.log(50) if word in known else -math.log(50) - len(word) * math.log(10)

    for run in ("abcd", "dabcab", "cdcd", "xaby"):
        places = {(i, n): math.log(known[run[i : i + n]]) for i in range(len(run)) for n in range(1, len(run) - i + 1) if run[i : i + n] in known}
        cuts = []
        for marks in itertools.product([0, 1], repeat=len(run) - 1):
            words, word = [], run[0]
            for c, m in zip(run[1:], marks):
                words, word = (words + [word], c) if m else (words, word + c)
            cuts.append(sum(map(cost, [*words, word])))
        assert sum(map(cost, urls.best_cut(run, places, math.log(50)))) == pytest.approx(max(cuts))


def test_names_decide_where_no_rule_does(spark):
    values = [f"http://redfox{i}.com/de/{i}" for i in range(30)] + [f"http://bluecat{i}.net/es/{i}" for i in range(30)]
    values += ["http://redfox.org/x", "http://bluecat.org/x"]
    table = pages(spark, values, "red fox blue cat red fox blue cat")
    got = {r.page_id: r.verdict for r in urls.judge_urls(table).collect()}
    assert (got[60], got[61]) == ("allow", "block")


# --- archives ---


def record(i, payload=b"<p>hello</p>", digest=None, extra=b""):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + payload
    digest = digest or hashlib.sha1(payload).hexdigest().encode()
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Payload-Digest: sha1:%s\r\n%s" % (i, digest, extra)
    return head + b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def read(data):
    found = list(warc.salvage(data))
    records = [int(x.record_id.rsplit(":")[-1]) for x in found if isinstance(x, warc.Record)]
    gaps = [(x.offset, x.length, x.reason) for x in found if isinstance(x, warc.Gap)]
    covered = sum(x.length for x in {(x.offset, x.length): x for x in found}.values())
    assert covered == len(data)
    return records, gaps


def test_intact_archives():
    assert read(b"") == ([], [])
    assert read(b"".join(record(i) for i in range(5))) == ([0, 1, 2, 3, 4], [])
    assert read(b"".join(gzip.compress(record(i)) for i in range(5))) == ([0, 1, 2, 3, 4], [])


def test_damage_is_quarantined():
    parts = [record(i, b"payload with WARC/1.1 inside %d" % i) for i in range(4)]
    at = len(parts[0])
    wrong_length = parts[1].replace(b"Content-Length: ", b"Content-Length: 9")
    for bad, reason in [
        (b"garbage" + b"\0" * 50, "no version line"),
        (wrong_length, "truncated"),
        (parts[1].replace(b"Content-Length", b"Content-Lungth"), "no length"),
        (record(1, digest=b"0" * 40), "digest differs"),
        (parts[1][:-20], "no end mark"),
    ]:
        records, gaps = read(parts[0] + bad + parts[2] + parts[3])
        assert records == [0, 2, 3] and gaps == [(at, len(bad), reason)], reason
    records, gaps = read(parts[0] + parts[1][:-6])
    assert records == [0] and gaps == [(at, len(parts[1]) - 6, "truncated")]


def test_damaged_members():
    parts = [gzip.compress(record(i)) for i in range(4)]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 0xFF
    records, gaps = read(parts[0] + bytes(broken) + parts[2] + b"\x1f\x8b\x08junk" + parts[3])
    assert records == [0, 2, 3] and [g[1] for g in gaps] == [len(parts[1]), 7]
    records, gaps = read(parts[0] + parts[1][:-3])
    assert records == [0] and gaps[0][2] in ("truncated member", "bad member")


def test_members_of_many_records():
    rnd = random.Random(4)
    parts = [record(i, bytes(rnd.randrange(256) for _ in range(3000))) for i in range(9)]
    parts[4] = parts[4].replace(b"Content-Length", b"Content-Lungth")
    records, gaps = read(gzip.compress(b"".join(parts)))
    start = len(b"".join(parts[:4]))
    assert records == [0, 1, 2, 3, 5, 6, 7, 8] and [g[2] for g in gaps] == [f"no length (bytes {start} to {start + len(parts[4])} of member)"]
    for level in (0, 6):
        whole = gzip.compress(b"".join(parts[:4]), level)
        records, gaps = read(whole[:-5000])
        assert records == [0, 1] and gaps[-1] == (0, len(whole) - 5000, "truncated member")
        # The checksum at the end is wrong: records have their own.
        records, gaps = read(record(7) + b"junk" + whole[:-8] + b"\0" * 8 + gzip.compress(record(8)))
        assert records == [7, 0, 1, 2, 3, 8] and [g[2] for g in gaps] == ["no version line", "bad member"]


def test_long_headers_and_base32_digests():
    long = b"WARC-Target-URI: data:," + b"x" * 200_000 + b"\r\n"
    assert read(record(0) + record(1, extra=long) + record(2))[0] == [0, 1, 2]
    good = base64.b32encode(hashlib.sha1(b"<p>hello</p>").digest())
    assert read(record(0, digest=good)) == ([0], [])
    records, gaps = read(record(0) + record(1, digest=b"A" * 32) + record(2))
    assert records == [0, 2] and [g[2] for g in gaps] == ["digest differs"]


def test_pages_with_long_urls_survive(spark):
    rows = [(1, "data:," + "a b" * 30_000, "x" * 1500), (2, "data:," + "y" * 100_000, "x" * 1500)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {(r.record_id, r.payload_bytes) for r in warc.write_and_read(table).collect()}
    assert got == {("urn:page:1", 1500), ("urn:page:2", 1500)}


def test_every_single_damaged_byte_leaves_the_neighbours():
    a, b, c = record(1), record(2), record(3)
    for at in range(len(b)):
        hurt = bytearray(b)
        hurt[at] ^= 0x55
        found = [x for x in warc.salvage(a + bytes(hurt) + c) if isinstance(x, warc.Record)]
        assert found[0].record_id == "urn:page:1" and found[-1].record_id == "urn:page:3"


def test_pages_survive_the_round_trip(spark):
    big = "x" * 1500
    rows = [
        (1, "http://a", big), (2, None, big), (3, "http://c\r\nWARC-Type: fake", big), (4, "", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"),
        (8, "u", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1"), (9, "é", "ü" * 600), (10, "é", "ü" * 600), (None, "n", "none"),
    ]
    table = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id bigint, url string, html string, digest string, n int")
    got = {warc_row.page_id: warc_row for warc_row in warc.write_and_read(table).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "kind", warc.page_of("refers_to").alias("refers_to")
    ).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.kind == "revisit"} == {1: 3, 2: 3, 9: 10}
    assert warc.write_and_read(table.limit(0)).count() == 0


def test_salvage_through_spark(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(1) + b"junk" + record(2))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record(3)) + b"\x1f\x8bjunk")
    (tmp_path / "empty.warc").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path), with_payload=True).collect()
    assert sorted(r.record_id for r in rows if r.kind == "response") == ["urn:page:1", "urn:page:2", "urn:page:3"]
    assert sorted(r.length for r in rows if r.kind == "gap") == [4, 6]
    assert {bytes(r.payload) for r in rows if r.kind == "response"} == {b"<p>hello</p>"}
    assert spark.range(1).select(F.lit(1)).count() == 1
