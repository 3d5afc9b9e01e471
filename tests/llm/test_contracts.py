"""Every query of the subpackage against a brute-force version over whole tables, an exact round trip or held-out accuracy."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cantor.llm import queries
from compare import of_duckdb, of_spark

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(table, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return rows_of("documents", "doc_id, text, lang")


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def get(name):
        if name not in made:
            made[name] = queries.QUERIES[name](spark, FOLDER).collect()
        return made[name]

    return get


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_statement(spark, name):
    columns, rows = of_spark(queries.QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = of_duckdb(queries.ORACLE_SQL[name], FOLDER)
    assert columns == wanted_columns
    assert rows == wanted, (list((rows - wanted).items())[:3], list((wanted - rows).items())[:3])


def test_packing_holds_every_id_once(result, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for d, t, _ in documents}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result("op1_packing"):
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert set(pieces) == set(ids)
    for d, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[d])
    padded = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        total += at
        padded += at if at & (at - 1) == 0 else 1024
    assert padded <= 1.05 * total


def base_of(text):
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, good in rules for m in re.finditer(p, text) if good(m.group())]


def test_personal_data_keeps_the_base(result, documents):
    got = {r.doc_id: r for r in result("op2_skip_chain")}
    assert len(got) == len(documents)
    for d, t, _ in documents:
        base, r = [f"{k}:{a}:{b}" for k, a, b in base_of(t or "")], got[d]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in ("email", "ip", "card", "phone")]
        assert set(base) <= set(r.spans.split(","))  | {""}


def test_archives_round_trip(result):
    pages = rows_of("pages", "page_id, html")
    last = {}
    for p, h in pages:
        last[h or ""] = max(p, last.get(h or "", p))
    got = {r.page_id: r for r in result("op3_chunked_warc")}
    assert len(got) == len(pages)
    for p, h in pages:
        data, r, winner = (h or "").encode(), got[p], last[h or ""]
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if p == winner else ("revisit", winner))


def test_search_finds_nine_of_ten(result):
    good = [(i, np.array(v, float)) for i, v in rows_of("embeddings", "vec_id, embedding") if v is not None and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    found = defaultdict(list)
    for r in result("op4_ivf_pq"):
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    queried = [i for i in ids if i % 20 == 0]
    assert sorted(found) == sorted(queried)
    hits = 0
    for q in queried:
        scores = {int(i): float(s) for i, s in zip(ids, x @ x[np.flatnonzero(ids == q)[0]]) if i != q}
        exact = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(s - scores[i]) < 1e-9 for _, i, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len(set(exact) & {m[1] for m in mine})
    assert hits >= 0.9 * 20 * len(queried)


def test_token_counts(result, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter((d, len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in documents)
    assert Counter((r.doc_id, r.n_tokens) for r in result("op6_separator_scan")) == wanted


def test_language_on_held_out_documents(result, documents):
    told = {d: lang for d, _, lang in documents}
    got = result("op7_word_backoff")
    assert len(got) == len(documents)
    judged = [(r.lang_pred, told[r.doc_id]) for r in got if r.held_out and told[r.doc_id] is not None and r.lang_pred != "und"]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1


def test_quality_counts(result, documents):
    got = {r.doc_id: r for r in result("op9_weak_supervision")}
    for d, t, _ in documents:
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        wanted = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def brute_groups(documents):
    sets = {}
    for d, t, _ in documents:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    common = Counter((a, b) for ds in where.values() for i, a in enumerate(ds) for b in ds[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_duplicates_equal_all_pairs(result, documents):
    wanted = brute_groups(documents)
    got = {r.doc_id: r for r in result("op10_lsh_forest")}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == wanted
    assert all(r.kept == (r.component_id == d) for d, r in got.items())
