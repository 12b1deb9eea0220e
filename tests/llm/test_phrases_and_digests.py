"""Collocations and fingerprints against brute-force versions over awkward rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from scholarlake.llm import collocations, fingerprints

from .fixtures import awkward_texts, documents, prose

TEXTS = awkward_texts()

# 11 collocations


def brute_phrases(rows: list[tuple[str | None, str | None]], words: int, least: int, covered: int, top: int) -> list[tuple]:
    f: dict[str, Counter] = defaultdict(Counter)
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, words + 1):
                f[lang or "und"].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(inside(q) and 100 * b >= covered * a for q, b in candidates.items()):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def collocation_rows() -> list[tuple[str | None, str | None]]:
    rng = random.Random(4)
    vocabulary = ["an", "der", "Öl", "x\x00y", "日本", "the", "e=1", "a"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "\t", "\v", " ;", "?!"]) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts += TEXTS + ["The END of the end\tof THE end. of the"] * 12 + [". , ;\n", None, ""]
    return [(rng.choice(["en", "de", None]), t) for t in texts]


def got_phrases(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("words", "least", "covered", "top"), [(3, 10, 50, 2000), (3, 2, 50, 40), (2, 3, 50, 2000), (4, 4, 80, 2000)])
def test_collocations_equal_brute_force(spark, words, least, covered, top):
    rows = collocation_rows()
    docs = spark.createDataFrame([(i, lang, t, 7, "w", "p") for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, f int, w1 string, phrase string").repartition(3)
    want = brute_phrases(rows, words, least, covered, top)
    assert len(want) > 20
    assert got_phrases(collocations.collocations(docs, words, least, covered, top)) == want


def test_collocations_hold_with_small_blocks_no_codes_and_hot_pairs(spark, monkeypatch):
    rows = [*collocation_rows(), *(("en", f"so hot {i % 7}x so hot {i}y") for i in range(400))]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = brute_phrases(rows, 3, 5, 50, 2000)
    monkeypatch.setattr(collocations, "COMBINE_BYTES", 50)  # a long text in several blocks, each cut where a piece ends
    assert got_phrases(collocations.collocations(docs, 3, 5)) == want
    monkeypatch.setattr(collocations, "CODED_WORDS", 0)
    monkeypatch.setattr(collocations, "LOOK_ROWS", 1)
    assert got_phrases(collocations.collocations(docs, 3, 5)) == want


def test_collocation_counts_pass_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 1, 3 * 10**12), ("en", "b", 1, 10**12 + 7), ("en", "a b", 2, 10**12)], "lang string, phrase string, size int, f long")
    assert [tuple(r) for r in collocations.scored_phrases(phrases).select("a", "l", "r", "score").collect()] == [(10**12, 3 * 10**12, 10**12 + 7, 10**6 * 10**24 // (3 * 10**12 * (10**12 + 7)))]


def test_collocation_sql_equals_operator(spark):
    rows = collocation_rows()
    con = duckdb.connect()
    con.execute("create table documents (lang varchar, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(lang, t) for lang, t in rows if "\x00" not in (t or "")])
    docs = spark.createDataFrame([r for r in rows if "\x00" not in (r[1] or "")], "lang string, text string")
    cur = con.execute(collocations.ORACLE)
    names = [d[0] for d in cur.description]
    want = [tuple(r[names.index(c)] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in cur.fetchall()]
    assert got_phrases(collocations.collocations(docs)) == sorted(want) and want


def test_collocations_of_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", ""), (None, None), ("en", " .\t")], "lang string, text string")).count() == 0


# 13 fingerprints


def brute_digest(text: bytes) -> tuple[str, list[int], int, int]:
    padded = text + bytes(max(0, 3 - len(text))) if text else b""
    counts = [0] * 256
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        counts[((a + 256 * b + 65536 * c) * 0x9E3779B1 % 2**32) >> 24] += 1
    ordered = sorted(counts)
    codes = [sum(n > ordered[q] for q in (63, 127, 191)) for n in counts]
    length = 0
    while length < 255 and (1 + len(text)) ** 8 >= 2 ** (length + 1):
        length += 1
    check = zlib.crc32(text) % 256
    body = bytes(sum(codes[4 * i + j] << 2 * j for j in range(4)) for i in range(64))
    return (bytes([check, length]) + body).hex(), codes, length, check


def brute_likeness(a: bytes, b: bytes) -> float:
    (_, x, m, c), (_, y, n, d) = brute_digest(a), brute_digest(b)
    cost = [0, 1, 2, 6]
    unrelated = sum(cost[abs(u - v)] for u in x for v in y) / 256
    body = min(1.0, sum(cost[abs(u - v)] for u, v in zip(x, y)) / max(unrelated, 1))
    return max(0.0, 1 - min(1.0, body + 0.5 * min(1.0, abs(m - n) / 64) + (c != d) / 512))


def brute_successors(rows: list[tuple[int | None, str | None]], hashes: list[int]) -> list[tuple]:
    order = sorted(((i is not None, i or 0, h), t or "", i) for (i, t), h in zip(rows, hashes))
    out = []
    for (_, t, i), (_, following, _) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        changed = (t[: len(t) - half] + following[:half]).encode()
        out.append((i, len(t), hashlib.sha256(changed).hexdigest(), brute_digest(t.encode())[0], brute_digest(changed)[0], round(brute_likeness(t.encode(), changed), 9), round(brute_likeness(t.encode(), following.encode()), 9)))
    return sorted(out, key=str)


def got_successors(df) -> list[tuple]:
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=str)


def hashes_of(spark, rows: list[tuple]) -> list[int]:
    return [r["h"] for r in spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i long, text string").select("i", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).orderBy("i").collect()]


@pytest.mark.parametrize("clashing", [False, True])
def test_fingerprints_equal_brute_force(spark, clashing):
    rows = list(enumerate(TEXTS))
    got = got_successors(fingerprints.fingerprint_successors(documents(spark, TEXTS, clashing)))
    assert got == brute_successors(rows, hashes_of(spark, rows))


def test_fingerprints_of_repeated_and_null_ids_in_many_ranges(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(20)]), rng.choice([None, "", "ab", prose(rng, 30)])) for _ in range(60)] + [(3, "same row " * 9)] * 15
    want = brute_successors(rows, hashes_of(spark, rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in (1, 7, 90):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            got = got_successors(fingerprints.fingerprint_successors(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
            assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_one_row_and_none(spark):
    assert fingerprints.fingerprint_successors(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    (one,) = fingerprints.fingerprint_successors(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1


def test_long_text_counts_like_its_pieces(monkeypatch):
    rng = random.Random(8)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 3, 4, 11, 30, 500, 20)]
    whole = fingerprints.bucket_counts(texts)
    monkeypatch.setattr(fingerprints, "CHUNK_BYTES", 10)
    assert (fingerprints.bucket_counts(texts) == whole).all()
    assert whole.sum(axis=1).tolist() == [0, 1, 1, 1, 2, 9, 28, 498, 18]


def test_fingerprint_text_round_trip_and_bounds():
    rng = random.Random(9)
    texts = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 300))) for _ in range(50)]
    digests = fingerprints.Digests.of(texts)
    again = fingerprints.Digests.read(digests.texts())
    assert (again.codes == digests.codes).all() and (again.lengths == digests.lengths).all() and again.texts() == digests.texts()
    assert (fingerprints.likeness(digests, again) == 1).all()
    between = fingerprints.likeness(digests[slice(0, 49)], digests[slice(1, 50)])
    assert ((0 <= between) & (between < 1)).all()
