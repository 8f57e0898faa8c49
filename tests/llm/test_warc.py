import base64
import glob
import gzip
import os
import hashlib
import random

import pytest

from ledgerloom.llm import warc

SCHEMA = "page_id long, url string, html string, sha string, kind int, refers string, record string, size long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, "y", "z", 1) for r in rows], SCHEMA).repartition(4)


def pages():
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", "<p>" + "é" * rng.randint(0, 50) + str(rng.randint(0, 9)) + "</p>") for i in range(60)]
    rows += [(100 + i, f"http://h/{i}", "<b>same</b>") for i in range(40)] + [(200, None, None), (201, "http://a b\r\nX: y", ""), (202, "u", "z" * 300_000)]
    rows += [(300, "http://r", "twice")] * 3 + [(None, "http://n", "<b>same</b>"), (None, "http://m", "only null id"), (None, "http://m", "only null id")]
    return rows


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    out, first, seen = [], {}, set()
    for i, _, html in rows:
        if i is not None and (html or "") not in first or i is not None and i < first[html or ""]:
            first[html or ""] = i
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        html = html or ""
        head = first.get(html)
        revisit = len(html.encode()) >= least and ((i, html) in seen or i != head)
        seen.add((i, html))
        out.append((i, len(html.encode()), digest(html), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip_matches_brute_force(spark, tmp_path, least):
    rows, folder = pages(), str(tmp_path / "a")
    manifest = warc.write_warc(table(spark, rows), folder, roll_bytes=3000, min_bytes=least).collect()
    got = warc.read_warc(spark, folder).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(rows, least)
    payload = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    assert all(payload[digest(h)] == (h or "").encode() for *_, h in rows)
    assert sum(m.records for m in manifest) == len(rows) and all(m.bytes <= 3000 or m.records == 1 for m in manifest) and len(manifest) > 4
    files = sorted(glob.glob(f"{folder}/part-*"))
    assert len(files) == len(manifest) and not glob.glob(f"{folder}/_temporary/*")
    whole = gzip.decompress(open(files[0], "rb").read())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and b"X: y\r\n" not in whole
    # pages are in order over the files
    ids = [r.page_id for r in sorted(got, key=lambda r: r.file) if r.page_id is not None]
    by_file = {}
    for r in got:
        by_file.setdefault(r.file, []).append(r.page_id)
    highest = [max(x for x in by_file[f] if x is not None) for f in sorted(by_file) if any(x is not None for x in by_file[f])]
    assert highest == sorted(highest) and len(ids) == len(rows) - 3


def test_same_bytes_on_every_run_and_damage_is_seen(spark, tmp_path):
    one, two = str(tmp_path / "a"), str(tmp_path / "b")
    for folder in (one, two):
        warc.write_warc(table(spark, pages()), folder, roll_bytes=3000)
    names = [p.removeprefix(one) for p in sorted(glob.glob(f"{one}/part-*"))]
    assert [open(one + n, "rb").read() for n in names] == [open(two + n, "rb").read() for n in names]
    data = open(one + names[0], "rb").read()
    open(one + names[0], "wb").write(data[:-40])
    with pytest.raises(Exception, match="cut off|records"):
        warc.read_warc(spark, one).collect()


def test_a_second_attempt_that_dies_leaves_every_file_of_the_manifest(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "a")
    record = warc.response("1", "http://a/", b"payload", digest("payload"))

    def attempt():
        roll = warc.Roll(folder, 0, 200)
        for _ in range(3):
            roll.add(record, False)
        return roll

    first = attempt().commit()
    before = {f["file"]: open(f"{folder}/{f['file']}", "rb").read() for f in first}
    assert len(before) == 3
    late = attempt()
    steps = []

    class Dying:
        """The file system, dying at the n-th call of the commit."""

        def __init__(self, store, n):
            self.store, self.n = store, n

        def __getattr__(self, name):
            steps.append(name)
            if len(steps) > self.n:
                raise RuntimeError("lost")
            return getattr(self.store, name)

    for n in range(6):
        late = attempt()
        late._close()
        late.store = Dying(late.store, n)
        steps.clear()
        try:
            late.commit()
        except RuntimeError:
            pass
        assert {name: open(f"{folder}/{name}", "rb").read() for name in before} == before
    # a stray that no manifest names goes, the others stay
    open(f"{folder}/part-00009-00000-x.warc.gz", "wb").write(b"x")
    manifest = spark.createDataFrame([(f["file"],) for f in first], "file string")
    assert warc.clear_strays(folder, manifest) == ["part-00009-00000-x.warc.gz"]
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/part-*")) == sorted(before)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "a")
    assert warc.write_warc(table(spark, []), folder).collect() == [] and warc.read_warc(spark, folder).collect() == []
