"""A planted book from files to a package: prepare, align, export; and what each step refuses."""

import io
import json
import os
import zipfile
from xml.etree import ElementTree

import numpy as np
import pytest

from cantor import cli, config
from cantor.functions.ctc import backend
from cantor.operators import align
from cantor.sources import emission, recording

PAGE = "<html><body><section id='one'><h2>First &amp; last</h2>{}</section></body></html>"
WORDS = "river stone garden window candle mirror harbor thunder velvet copper lantern meadow".split()


def texts(n, size=14, seed=4):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS, size)) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """A work directory of one book of 12 paragraphs, read in two files, and its planted emission."""
    root = tmp_path_factory.mktemp("work")
    (root / "in").mkdir()
    (root / "in" / "a tale.html").write_text(PAGE.format("".join(f"<p>{t}</p>" for t in texts(12))))
    (root / "sound").mkdir()
    for name in ("b.mp3", "a.MP3"):
        (root / "sound" / name).write_bytes(name.encode())
    model = backend("letters")
    logits, marks = align.synthetic_emission([w.strip(".") for t in texts(12) for w in t.split()], model, frames_per_letter=2, gap=3, lead=100, trail=150)
    half = marks[6 * 14][0] - 2
    for section, part in ((1, logits[:half]), (2, logits[half:])):
        for k, at in enumerate(range(0, len(part), 700)):
            rows = part[at : at + 700]
            folder = root / "book" / "emission" / "book_id=1" / f"section={section}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{k:03d}-{len(rows) * 480}.f32").write_bytes(rows.astype("<f4").tobytes())
    return root, marks, half


def run(root, *argv):
    return cli.parser().parse_args([argv[0], "--dir", str(root / "book"), *argv[1:]])


def test_a_book_goes_from_files_to_a_package(work, spark, capsys):
    root, marks, half = work
    args = run(root, "prepare", "--text", str(root / "in" / "a tale.html"), "--audio-dir", str(root / "sound"), "--reader", "Ann & Bo")
    secs = iter((half * 0.03, 40.0))
    assert "2 audio files" in cli.prepare(args, probe=lambda file: next(secs))
    doc = json.loads((root / "book" / "work.json").read_text())
    assert doc["book"]["title"] == "a tale" and doc["text"]["paragraphs"] == 12 and doc["audio"]["sections"][0]["file"] == "audio/0001.mp3"
    assert doc["book"]["author"] is None and "alignment" not in doc
    assert (root / "book" / "audio" / "0001.mp3").read_bytes() == b"a.MP3"

    assert cli.main(["export", "--dir", str(root / "book"), "--out", str(root / "out")]) == 1
    assert "no alignment" in capsys.readouterr().err
    assert cli.main(["align", "--dir", str(root / "book"), "--dry"]) == 0
    assert "alignment" not in json.loads((root / "book" / "work.json").read_text())
    assert cli.main(["align", "--dir", str(root / "book")]) == 0
    assert "passed" in capsys.readouterr().out
    doc = json.loads((root / "book" / "work.json").read_text())
    got = doc["alignment"]
    assert got["verdict"]["pass"] and got["meta"]["placed"] == 12 and got["meta"]["sections"] == 2 and got["meta"]["inversions"] == 0
    for p in range(12):
        begin = min(row[1] for row in got["phrases"][f"text-p{p + 1}"])
        assert abs(begin - marks[14 * p][0] * 0.03) <= 0.04
        assert got["phrases"][f"text-p{p + 1}"][0][3] == (1 if p < 6 else 2)
        assert [w[1] for w in got["words"][f"text-p{p + 1}"]] == [w.strip(".") for w in texts(12)[p].split()]

    assert cli.main(["export", "--dir", str(root / "book"), "--out", str(root / "out")]) == 0
    with zipfile.ZipFile(root / "out" / "book.epub") as z:
        first = z.infolist()[0]
        assert (first.filename, first.compress_type) == ("mimetype", zipfile.ZIP_STORED)
        for name in z.namelist():
            if name.endswith(("opf", "xhtml", "smil", "xml")):
                ElementTree.fromstring(z.read(name))
        smil, opf, nav = (z.read(f"book/{n}").decode() for n in ("book.smil", "content.opf", "nav.xhtml"))
        assert smil.count("<par ") == 12 and 'sound/0002.mp3" clipBegin="0.0' in smil
        assert "Ann &amp; Bo" in opf and "First &amp; last" in nav and z.read("book/sound/0002.mp3") == b"b.mp3"

    (root / "book" / "book.html").write_text("<p id='x'>changed since</p>")
    assert cli.main(["export", "--dir", str(root / "book"), "--out", str(root / "out")]) == 1
    assert "text changed since alignment" in capsys.readouterr().err


def test_arguments_are_checked(capsys):
    with pytest.raises(SystemExit) as e:
        cli.main(["prepare", "--dir", "x"])
    assert e.value.code == 2
    with pytest.raises(SystemExit) as e:
        cli.main(["--help"])
    assert e.value.code == 0


def packed(title="A <Tale>", creator="Doe, Jane", idrefs=("cover", "one", "two")):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/p.opf"/></rootfiles></container>')
        meta = f"<dc:title>{title.replace('<', '&lt;')}</dc:title><dc:creator>{creator}</dc:creator>" if title else ""
        items = "".join(f'<item id="{i}" href="text/{i}.xhtml"/>' for i in idrefs)
        z.writestr("OEBPS/p.opf", f'<package xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata>{meta}</metadata><manifest>{items}</manifest><spine>{"".join(f"<itemref idref={chr(34)}{i}{chr(34)}/>" for i in idrefs)}</spine></package>')
        for i in idrefs:
            z.writestr(f"OEBPS/text/{i}.xhtml", f"<html><body><h1>Part {i}</h1><p>Some words of {i} here</p><p id='own'>more words</p></body></html>")
    return data.getvalue()


def test_a_fetched_book_is_parked_and_anchored(spark, tmp_path):
    asked = []

    def get(url):
        asked.append(url)
        return None if "images" in url else packed()

    args = cli.parser().parse_args(["fetch-text", "--id", "77", "--dir", str(tmp_path / "w")])
    cli.fetch_text(args, get)
    doc = json.loads((tmp_path / "w" / "work.json").read_text())
    assert doc["book"] == {"title": "A <Tale>", "author": "Jane Doe", "language": "en", "source": {"kind": "gutenberg", "id": "77", "url": "https://www.gutenberg.org/ebooks/77"}}
    assert [u.rpartition("/")[2] for u in asked] == ["pg77-images.epub", "pg77.epub"]
    from cantor import pipelines

    [row] = pipelines.anchored_source(spark, str(tmp_path / "w" / "book.epub")).collect()
    assert row.body.count("<section") == 2 and 'id="part-one-p1"' in row.body and 'id="own"' in row.body and "cover" not in row.body
    with pytest.raises(OSError):
        recording.fetch_epub("1", lambda url: None)


def test_a_feed_is_fetched_once(spark, tmp_path):
    feed = {"books": [{"title": "T", "url": "u", "sections": [{"section_number": "10", "title": " ", "listen_url": "http://www.archive.org/b", "readers": []}, {"section_number": "2", "title": "Two", "listen_url": "http://x/a", "readers": [{"display_name": " Ann "}]}]}]}
    (tmp_path / "feed.json").write_text(json.dumps(feed))
    got = []

    def fetch(url, file, label):
        got.append(url)
        if len(got) == 1:
            raise OSError("once more")
        with open(file, "wb") as f:
            f.write(b"x")

    args = cli.parser().parse_args(["fetch-audio", "--feed", str(tmp_path / "feed.json"), "--dir", str(tmp_path / "w")])
    cli.fetch_audio(args, fetch, lambda file: 1.5)
    cli.fetch_audio(args, fetch, lambda file: 1.5)
    assert got == ["https://x/a"[:0] + "http://x/a".replace("http:", "https:")] * 2 + ["https://archive.org/b"]
    doc = json.loads((tmp_path / "w" / "work.json").read_text())
    assert [(s["position"], s["title"], s["reader"], s["secs"]) for s in doc["audio"]["sections"]] == [(1, "Two", "Ann", 1.5), (2, None, None, 1.5)]


def test_chunks_are_scored_and_cut_anew(spark):
    files = spark.createDataFrame([(1, 1, bytearray(b"a" * 3)), (1, 2, bytearray(b"b" * 2)), (2, 1, bytearray(b"c"))], "book_id long, section int, content binary")
    decode = lambda data: np.full(len(data) * 16_000 * 30, data[0], np.float32)
    forward = lambda x: np.tile(np.arange(len(x) // 320, dtype=np.float32)[:, None], 2) + x[0] * 1000
    chunks = emission.scored(files, decode, forward).cache()
    assert [(r.section, r.chunk, r.frames) for r in chunks.where("book_id = 1").orderBy("section", "chunk").collect()] == [(1, 0, 2000), (1, 1, 2000), (1, 2, 500), (2, 0, 2000), (2, 1, 1000)]
    books = {r.book_id: (r.ratio, r.bounds) for r in emission.books(chunks).collect()}
    assert books == {1: (0.02, [0, 4500, 7500]), 2: (0.02, [0, 1500])}
    whole = np.concatenate([np.frombuffer(r.logits, "<f4").reshape(-1, 2) for r in chunks.where("book_id = 1").orderBy("section", "chunk").collect()])
    blocks = emission.blocks(chunks, 700, 2).where("book_id = 1").orderBy("block").collect()
    assert [len(r.logits) for r in blocks] == [5600] * 10 + [4000]
    assert np.array_equal(np.concatenate([np.frombuffer(r.logits, "<f4").reshape(-1, 2) for r in blocks]), whole)
    assert emission.cuts(16_000 * 40 + 639) == [(0, 640_000)] and emission.cuts(16_000 * 40 + 640)[1] == (640_000, 640_640)


def test_settings():
    assert config.load({}) == config.Config()
    for bad in ("", "x", "-1", "0", "nan", "inf"):
        assert config.load({"CANTOR_STREAM_SECS": bad}).stream_secs == 54_000
    assert config.load({"CANTOR_STREAM_SECS": "12.5"}).stream_secs == 12.5


def test_the_package_names_its_modules():
    import cantor

    assert all(getattr(cantor, name) for name in cantor.__all__)
    with pytest.raises(AttributeError):
        cantor.nothing


def test_the_entry_lives_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__

    monkeypatch.setitem(sys.modules, "cantor.llm", None)
    monkeypatch.setitem(sys.modules, "cantor.llm.queries", None)
    assert "verdict" in __spark_entry__.queries() and not any(q.startswith("op") for q in __spark_entry__.queries())
    assert os.path.exists(__spark_entry__.__file__)
