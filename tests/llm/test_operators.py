"""Each operator against a brute-force version over awkward rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import pickle
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scholarlake.llm import chat, common, decontamination, line_dedup, near_dedup, nearest, pieces, quality, sharding, substring_dedup, token_output
from scholarlake.llm.queries import tokenizer_path

from .fixtures import awkward_texts, documents, prose

TEXTS = awkward_texts()
BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(params=[False, True], ids=["plain", "clashing"])
def docs(spark, request):
    return documents(spark, TEXTS, request.param)


# 1 substring dedup


def test_substrings_equal_brute_force(spark, docs):
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substring_dedup.digest(substring_dedup.dedup_substrings(docs, 200)).collect()}
    want = dict(enumerate(substring_dedup.brute_force([(t or "").encode() for t in TEXTS])))
    assert got == want
    assert sum(w[0] > 0 for w in want.values()) > 8


def test_substring_edges_equal_brute_force_on_random_copies(spark, monkeypatch):
    rng = random.Random(5)
    source = "".join(rng.choice("abcd") for _ in range(3000))
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            a = rng.randrange(2600)
            parts.append(source[a : a + rng.randint(150, 420)])
            parts.append("".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))))
        texts.append("".join(parts))
    want = dict(enumerate(substring_dedup.brute_force([t.encode() for t in texts])))
    for hot in (substring_dedup.HOT_CONTENTS, 1):  # the second sends all edges through the counting path
        monkeypatch.setattr(substring_dedup, "HOT_CONTENTS", hot)
        got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substring_dedup.digest(substring_dedup.dedup_substrings(documents(spark, texts), 200)).collect()}
        assert got == want


def test_many_equal_rows_cost_no_more_than_their_number(spark):
    """Copies of a row share its key; their runs are gathered once, not once for each copy."""
    text = prose(random.Random(11), 700)[:4000]
    df = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
    began = time.monotonic()
    got = substring_dedup.digest(substring_dedup.dedup_substrings(df, 200)).distinct().collect()
    assert [(r["doc_id"], r["n_removed"], r["n_spans"]) for r in got] == [(7, len(text.encode()), 1)]
    assert time.monotonic() - began < 90  # 98 s for 800 rows while the runs of all copies were gathered


def test_long_text_in_pieces(spark):
    rng = random.Random(1)
    part = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    long = part + "".join(rng.choice("ijkl") for _ in range(400_000)) + part[:5000]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in substring_dedup.digest(substring_dedup.dedup_substrings(documents(spark, [long, "q" * 10]), 200)).collect()}
    assert got == {0: (10_000, 2), 1: (0, 0)}


def test_matching_statistics_equal_direct_search():
    rng = random.Random(2)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).encode() for _ in range(30)] + [b"abab" * 12]
    index = substring_dedup.RunLengthIndex(strings)
    got = index.matching_statistics()
    places = [(i, p) for i, s in enumerate(strings) for p in range(len(s))]
    for i, p in places:
        best, s = 0, strings[i][p:]
        for j, q in places:
            if (i, p) != (j, q):
                k = 0
                t = strings[j][q:]
                while k < min(len(s), len(t)) and s[k] == t[k]:
                    k += 1
                best = max(best, k)
        assert got[index.starts[i] + p] == best
    assert len(index.run_heads) < index.n


# 2 token output


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_001, dtype=np.uint64).astype(np.uint32)
    f = token_output.PackedFile(token_output.write_file([3, None], [10_000, 1], ids, bits, 64))
    assert (f.read(0, len(ids)) == ids).all() and (f.read(777, 3001) == ids[777:3001]).all() and (f.document(1) == ids[-1:]).all()


def test_token_files_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output.read_documents(token_output.write_ids(docs, BPE)).collect()}
    start, want = 0, {}
    for i, text in enumerate(TEXTS):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_special_strings_and_rare_characters_encode_like_the_library():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(BPE), token_output.Encoder(BPE)
    for text in ["a<|endoftext|>b", "naïve  café's x　y", "½² ١٢ क्षि \U0001f600", "  lead", "tail \n\n ", "we'll 'tis 'S", "a_b __x _1 1_ x²y 3¼", "a\x1cb\x1d \x85c\xa0 d", "".join(map(chr, range(1, 0x250))), "Ά·ώ ЀҁЪ  12٣ 가힣 ァヺー"]:
        assert e.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids
    rng = random.Random(6)
    parts = ["'", "s", "t", "re", "ll", "'ve", " ", "  ", "\n", "\t", "x", "1", "é", "!", "''", " '", "日本", "_", "\xa0", "\u3000", ".", "<|endoftext|>", "²"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    got = [x.tolist() for _, ids, n in e.encode_texts(pa.array(texts)) for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_long_texts_encode_in_windows(spark, monkeypatch):
    from tokenizers import Tokenizer

    from scholarlake.llm import chunks

    rng = random.Random(4)
    texts = [prose(rng, 900), None, "x" * 9000, "日本 " * 3000 + "'s", "\n".join(prose(rng, 40) for _ in range(30)), ""]
    t, sp = Tokenizer.from_file(BPE), pieces.Encoder(pieces.PieceModel(PIECES), 0.1, 17)
    whole = [sp.encode(x or "", i) for i, x in enumerate(texts)]
    small = lambda *a, **k: chunks.text_windows(*a[:2], limit=1000, **k)
    monkeypatch.setattr(token_output, "text_windows", small)
    got = {int(r): x.tolist() for rows, ids, n in token_output.Encoder(BPE).encode_texts(pa.array(texts)) for r, x in zip(rows, np.split(ids, np.cumsum(n)[:-1]))}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    monkeypatch.setattr(pieces, "text_windows", lambda texts, lead, _limit, breaks: small(texts, lead, breaks=breaks))
    got = {int(r): (x.tolist(), bool(o)) for rows, ids, n, ok in sp.encode_texts(pa.array(texts), list(range(6))) for r, x, o in zip(rows, np.split(ids, np.cumsum(n)[:-1]), ok)}
    assert got == {i: (x, True) for i, x in enumerate(whole)}


def test_rows_of_one_doc_id_have_a_determined_order(spark):
    rows = [(1, f"text {i % 7}") for i in range(40)] + [(2, None), (None, "z")]
    one = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (sorted(map(str, token_output.read_documents(token_output.write_ids(df, BPE)).collect())) for df in (one.repartition(1), one.repartition(5)))
    assert a == b


# 3 decontamination

ITEMS = [(1, " ".join((TEXTS[16] or "").split(" ")[22:40])), (2, "One"), (3, None), (4, ""), (5, "no such words here"), (10, " ".join((TEXTS[5] or "").split(" ")[:12])), (1, "two WORDS!"), (None, "two words"), (None, " ".join((TEXTS[5] or "").split(" ")[40:52]))]


def test_decontamination_equals_brute_force(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(decontamination.brute_force(list(enumerate(TEXTS)), ITEMS))
    assert sorted(map(tuple, decontamination.digest(decontamination.contamination(docs, items)).collect())) == want
    kept = {r["doc_id"] for r in decontamination.remove_contaminated(docs, items).collect()}
    assert kept == {w[0] for w in want if not w[-1]}
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 2)  # several broadcast blocks, in one pass and in several
    for blocks in (decontamination.PASS_BLOCKS, 2):
        monkeypatch.setattr(decontamination, "PASS_BLOCKS", blocks)
        assert sorted(map(tuple, decontamination.digest(decontamination.contamination(docs, items)).collect())) == want


def test_items_without_id_mark_words(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "alpha beta"), (7, "gamma"), (None, "delta")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontamination.digest(decontamination.contamination(docs, items)).collect()}
    assert got == {1: (3, 2, hashlib.sha256(b"7").hexdigest(), True), 2: (1, 1, hashlib.sha256(b"").hexdigest(), True)}


def test_shift_table_skips_and_finds_random_patterns():
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(3000))
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(3, 9)))) for i in range(30)]
    n, found = decontamination.Searcher(items, 10).scan(np.frombuffer((text + " ").encode(), np.uint8), np.array([0, len(text) + 1]))
    want = decontamination.brute_force([(0, text)], items)[0]
    assert n[0] == want[1] and len(found[0][1]) == want[2] and len(found[0][2]) == want[3]


def test_shift_tables_grow_with_their_patterns():
    rng = random.Random(4)
    made = lambda n: decontamination.Searcher([(i, " ".join(str(rng.randrange(50_000)) for _ in range(60))) for i in range(n)], 10).tables[0][0]
    at = time.time()
    few, many = made(100), made(6_000)
    assert time.time() - at < 60
    assert len(few.starts) == 100 * 51 and len(many.starts) == 6_000 * 51
    for table in (few, many):
        assert (table.shift == 0).mean() < 1 / 16 and table.shift.mean() > 8


def test_repeated_windows_are_one_pattern_of_many_items():
    boiler = "choose one of the following answers and give a reason for it"
    items = [(i, f"{boiler} question {i}") for i in range(300)]
    searcher = decontamination.Searcher(items, 10)
    (table, bounds, owners), = searcher.tables
    assert len(table.starts) == 4 + 300  # of an item's five windows only the last holds its number
    text = f"x {boiler.upper()} y. {boiler}, question 7"
    n, found = searcher.scan(np.frombuffer((text + " ").encode(), np.uint8), np.array([0, len(text) + 1]))
    want = decontamination.brute_force([(0, text)], items)[0]
    assert (n[0], len(found[0][1]), len(found[0][2])) == want[1:4] and want[3] == 300


def test_windows_of_one_hash_are_told_apart_by_bytes():
    raw = np.frombuffer(b"ab ab ac abc ac ", np.uint8)
    order, first = decontamination._distinct(np.zeros(5, np.uint64), raw, np.array([0, 3, 6, 9, 13]), np.array([3, 3, 3, 4, 3]))
    runs = [sorted(raw[[0, 3, 6, 9, 13][i] :][: [3, 3, 3, 4, 3][i]].tobytes() for i in order[a:b]) for a, b in zip(first, [*first[1:], 5])]
    assert all(len(set(r)) == 1 for r in runs) and sum(map(len, runs)) == 5 and len(runs) >= 3


def test_searchers_are_built_by_tasks_in_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 200)
    items = spark.createDataFrame([(i, f"item number {i} " * 4) for i in range(20)] + [(99, "long " * 200), (100, None), (3, "item number 3 " * 4)], "item_id long, text string")
    blocks = [pickle.loads(bytes(r[0])) for r in decontamination.searchers(items).collect()]
    assert sorted(i for b in blocks for i in b.ids) == [*range(20), 99] and len(blocks) > 5
    assert all(len(b.ids) == 1 or len(b.raw) <= 200 + 60 for b in blocks)


# 4 chat


def test_snapshots_collapse_to_maximal_conversations(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", None), ("assistant", "")]
    rows = [(c, t, *turns[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 3)) for t in range(n)]
    rows += [(5, 0, "user", "b"), (6, 0, "user", "a"), (6, 1, "assistant", "c"), (7, 600, "user", "a"), (7, 1200, "assistant", "c"), (7, 1300, "user", "z"), (8, None, None, None), (None, 1, "user", "q"), (5, 0, "user", "b")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, place int")
    got = {(r["conv_id"], r["part"]): (r["n_turns"], r["n_copies"], r["rendered"]) for r in chat.render_conversations(df).collect()}
    assert set(got) == {(2, 0), (5, 0), (7, 1), (7, 2), (8, -1)}
    assert got[2, 0] == (4, 2, "".join(f"<|im_start|>{r}\n{t or ''}<|im_end|>\n" for r, t in turns))
    assert chat.render_conversations(df.limit(0)).count() == 0


def test_turns_of_one_number_come_in_bounded_pieces(spark):
    rng = random.Random(5)
    rows = [(1, 7, rng.choice(["user", None]), f"{i:05d} " + "x" * 40) for i in range(3_000)] + [(2, None, "user", str(i)) for i in range(700)] + [(3, i, "user", str(i)) for i in range(1_100)] + [(4, i, "user", str(i)) for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, k int, part int").repartition(5)
    got = {}
    for r in sorted(chat.render_conversations(df).collect(), key=lambda r: (r["piece"], r["part"])):
        assert r["rendered"].count(chat.OPEN) <= chat.BLOCK_TURNS
        got.setdefault(r["conv_id"], []).append(r)
    none_first = lambda r: tuple((x is not None, x if x is not None else "") for x in r[1:])
    for conv in (1, 2, 3):  # 4 is the first turns of 3
        want = sorted((r for r in rows if r[0] == conv), key=none_first)
        assert "".join(r["rendered"] for r in got[conv]) == "".join(f"{chat.OPEN}{r[2] or ''}\n{r[3]}{chat.CLOSE}" for r in want)
        assert {(r["n_turns"], r["n_copies"]) for r in got[conv]} == {(len(want), 1)}
    assert set(got) == {1, 2, 3} and {r["part"] for r in got[2]} == {-1} and {(r["part"], r["piece"]) for r in got[3]} == {(0, 0), (1, 1), (2, 2)}


def test_a_conversation_is_rendered_whole(spark, tmp_path):
    import duckdb

    from scholarlake.llm import queries

    rng = random.Random(7)
    turns = [None, -600, -1, *range(1_300)]
    rows = [(1, n, rng.choice(["user", None]), f"text {i}") for i, n in enumerate(turns)] + [(2, 7, "user", f"{i:05d}") for i in range(1_100)] + [(3, i, "user", str(i)) for i in range(600)] + [(4, i, "user", str(i)) for i in range(550)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op4_chat(spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 3]  # 4 is the first turns of 3
    for conv, r in got.items():
        want = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[3]))
        assert r["rendered"] == "".join(f"{chat.OPEN}{x[2] or ''}\n{x[3]}{chat.CLOSE}" for x in want) and (r["n_turns"], r["n_copies"]) == (len(want), 1)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(f"select conv_id, part, n_turns, n_copies, rendered from ({queries.ORACLES['op4_chat']})").fetchall()) == sorted(tuple(r[c] for c in ("conv_id", "part", "n_turns", "n_copies", "rendered")) for r in got.values())


def test_collapse_equals_brute_force(spark):
    rng = random.Random(6)
    logs = {c: [rng.choice(["a", "b", None, ""]) for _ in range(rng.randint(1, 4))] for c in range(80)}
    rows = [(c, i, "user", t) for c, log in logs.items() for i, t in enumerate(log)]
    got = sorted((r["conv_id"], r["n_turns"], r["n_copies"]) for r in chat.render_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    longer = lambda log: any(len(o) > len(log) and o[: len(log)] == log for o in logs.values())
    want = [(c, len(log), sum(o == log for o in logs.values())) for c, log in logs.items() if not longer(log) and all(o != log or k >= c for k, o in logs.items())]
    assert got == sorted(want)


# 5 pieces


def test_encoding_without_dropout_equals_sentencepiece():
    import sentencepiece

    sp, e = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Encoder(pieces.PieceModel(PIECES))
    for t in TEXTS:
        if t and "▁" not in t and "\x00" not in t:
            assert e.encode(t) == sp.encode(t)


def test_dropout_is_lossless_seeded_and_varied(spark, docs):
    one = {r["doc_id"]: r for r in pieces.encode_documents(docs, PIECES).collect()}
    assert len(one) == len(TEXTS) and all(r["lossless"] for r in one.values())
    assert one[0]["ids"] == [] and one[1]["n_ids"] == 0
    again = {r["doc_id"]: r["ids"] for r in pieces.encode_documents(docs.repartition(2), PIECES).collect()}
    assert again == {d: r["ids"] for d, r in one.items()}
    other = pieces.encode_documents(docs, PIECES, seed=18)
    assert sum(r["ids"] != again[r["doc_id"]] for r in other.collect()) > 10
    back = {r["doc_id"]: r["text"] for r in pieces.decode_documents(other, PIECES).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_dropout_varies_between_occurrences_and_equals_the_plain_method(spark, monkeypatch):
    word, texts = "international", TEXTS[16:40]
    rows = [(d, " ".join([word] * 200)) for d in (1, 2, 2)]
    ids = [r["ids"] for r in pieces.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).orderBy("doc_id").collect()]
    assert ids[0] != ids[1] == ids[2]
    model = pieces.PieceModel(PIECES)
    whole = model.merge(" " + word)
    for found in ids[:2]:
        starts = [i for i, x in enumerate(found) if model.bytes[x].startswith(b" ")]
        seen = [tuple(found[a:b]) for a, b in zip(starts, [*starts[1:], None])]
        assert len(seen) == 200 and len(set(seen)) > 3 and tuple(whole) in seen
    # every chunk alone, with a heap, gives the same; so does a memory that is full at once
    texts = [*texts, TEXTS[9], TEXTS[12], TEXTS[13], "Ωmega ẞ " * 40]
    plain = []
    for i, t in enumerate(texts):
        key, place, out = pieces.Encoder(model, 0.1, 17).document_key(t.encode(), i % 3), 0, []
        for chunk in pieces.CHUNKS[0][0].findall(" " + t):
            out += model.merge(chunk, pieces.skips_of(pieces.chunk_key(key, place)[0], 0.1))
            place += len(chunk.encode())
        plain.append(out)
    for bits in (pieces.MEMORY_BITS, 11):
        monkeypatch.setattr(pieces, "MEMORY_BITS", bits)
        shared = pieces.Encoder(model, 0.1, 17)
        assert [shared.encode(t, i % 3) for i, t in enumerate(texts)] == plain
    keys = np.random.default_rng(0).integers(0, 1 << 62, 2000).astype(np.uint64)
    drawn = pieces.skip_rows(keys, np.full(2000, 100), 0.1)
    assert abs(int((drawn < 100).sum()) - 20_000) < 600 and (pieces.skip_rows(keys, np.full(2000, 100), 0.0) >= 100).all()


# 6 near-dedup


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs, words, percent):
    got = sorted(map(tuple, near_dedup.digest(near_dedup.near_duplicates(docs, words, percent)).collect()))
    assert got == near_dedup.brute_force(list(enumerate(TEXTS)), words, percent)
    kept = near_dedup.keep_one(docs, words, percent)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [g[0] for g in got if g[3]]


def test_chains_of_near_copies_are_one_component(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(60):  # neighbours are near copies, far ones are not
        words = words[:]
        words[rng.randrange(200)] = f"n{i}"
        words[rng.randrange(200)] = f"m{i}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    got = sorted(map(tuple, near_dedup.digest(near_dedup.near_duplicates(documents(spark, texts), 3, 85)).collect()))
    assert got == near_dedup.brute_force(list(enumerate(texts)), 3, 85)


def test_copies_with_many_edit_rates_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    texts = []
    for base in range(2):
        words = [f"b{base}w{i}" for i in range(150)]
        for _ in range(60):
            rate = rng.choice([0, 0.01, 0.02, 0.03, 0.05, 0.08])
            texts.append(" ".join(f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in words))
    want = near_dedup.brute_force(list(enumerate(texts)), 3, 85)
    assert 10 < sum(w[3] for w in want) < 110
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)  # several cells in a bucket
    assert sorted(map(tuple, near_dedup.digest(near_dedup.near_duplicates(documents(spark, texts), 3, 85)).collect())) == want


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 1 << 62, 3000).astype(np.uint64), rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    b[:2400] = a[:2400]
    r = near_dedup.registers([np.sort(a), np.sort(b), np.unique(np.concatenate([a, b])), a[:1], np.zeros(0, np.uint64)])
    assert (near_dedup.merge_registers(r[0], r[1]) == r[2]).all() and r[3].min() > 0 and r[4].max() == 0
    est = near_dedup.joint_estimate(np.array([(r[0] > r[1]).sum()]), np.array([(r[0] < r[1]).sum()]), np.array([3000.0]), np.array([3000.0]))
    assert abs(est[0] - 2400 / 3600) < 0.13


def test_texts_under_one_doc_id_keep_their_links_beside_repeated_rows(spark):
    texts = [prose(random.Random(100 + i), 150) for i in range(12)]
    rows = []
    for i in range(0, 12, 2):
        rows += [(i, texts[i]), (i, texts[i + 1]), (100 + i, texts[i] + " tail"), (101 + i, texts[i + 1] + " tail")]
    df = spark.createDataFrame([*rows, *rows[:2]], "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df, 3, 85).collect()}
    assert got == {(d, i) for i in range(0, 12, 2) for d in (i, 100 + i, 101 + i)}


# 7 line dedup


def _lines_by_hand(rows, min_chars=40, min_docs=5):
    import collections

    key = lambda line: line.encode().strip(line_dedup.BLANKS).lower().decode()
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_line_dedup_equals_brute_force(spark, docs):
    want = _lines_by_hand(list(enumerate(TEXTS)))
    assert sum(w[1] for w in want.values()) > 4
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_dedup.digest(out).collect()} == want


def test_rows_of_one_doc_id_are_one_document(spark):
    line = "A line of more than forty characters, as it has to be."
    rows = [(1, line), (1, line), (1, line), (2, line), (2, line), (None, line), (None, None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, _n_lines int")
    names = ("lines", "lost")
    assert all(r["lost"] == 0 and r["_n_lines"] == 5 for r in line_dedup.drop_repeated_lines(df, counts=names).collect())
    more = df.unionByName(spark.createDataFrame([(i, line, 5) for i in (3, 4, 5)], df.schema))
    got = sorted((r["doc_id"], r["lost"]) for r in line_dedup.drop_repeated_lines(more, counts=names).where("doc_id is not null").collect())
    assert got == [(1, 1)] * 3 + [(2, 1)] * 2 + [(3, 1), (4, 1), (5, 0)]


def test_counts_and_filters_are_reversible(spark):
    docs = documents(spark, TEXTS)
    refs = line_dedup.count_lines(docs, shards=4)
    more = docs.where("doc_id >= 20").withColumn("doc_id", F.col("doc_id") + 1000)
    grown = line_dedup.update_counts(refs, added=more)
    whole = line_dedup.count_lines(docs.unionByName(more), shards=4)
    rows = lambda df: sorted(map(tuple, df.select("shard", "k1", "k2", "refs").collect()))
    assert rows(grown) == rows(whole) != rows(refs)
    with_last = lambda df: sorted(map(tuple, df.select("shard", "k1", "k2", "refs", "last").collect()))
    held = line_dedup.line_holders(docs.unionByName(more))
    assert with_last(line_dedup.update_counts(grown, removed=more, holders=held)) == with_last(refs)
    with pytest.raises(ValueError, match="holders"):
        line_dedup.update_counts(grown, removed=more)
    # a table with most shards empty, and filters that follow the counts there and back
    line = "Line {} of a text that is long enough to count here."
    few = spark.createDataFrame([(d, "\n".join(line.format(i) for i in range(d % 4, 8))) for d in range(7)], "doc_id long, text string")
    extra = spark.createDataFrame([(100 + d, "\n".join(line.format(i) for i in range(0, 20))) for d in range(5)], "doc_id long, text string")
    old = line_dedup.count_lines(few, shards=64)
    new = line_dedup.update_counts(old, added=extra)
    frequent = lambda r: r.where("refs >= 5")
    filters = line_dedup.update_filters(line_dedup.build_filters(frequent(old)), old, new)
    both = few.unionByName(extra)
    digests = lambda df, **k: sorted(map(tuple, line_dedup.digest(line_dedup.drop_repeated_lines(df, **k)).collect()))
    assert digests(both, refs=new, filters=filters) == digests(both) != digests(both, refs=old)
    back = line_dedup.update_filters(filters, new, old)
    for r in back.collect():
        f, keys = line_dedup.CuckooFilter.from_bytes(r["filter"]), frequent(old).where(F.col("shard") == r["shard"]).collect()
        assert (f.cells > 0).sum() == len(keys)
    assert digests(few, refs=old, filters=back) == digests(few)


def test_stored_counts_judge_like_the_whole_table(spark):
    """Documents are added, judged and deleted in turns; each time what the state says is what one batch over all of them says."""
    rng = random.Random(12)
    line = "Line {} of a text that is long enough to count here, and more."
    frame = lambda ids: spark.createDataFrame([(i, texts[i]) for i in sorted(ids)], "doc_id long, text string")
    texts = {i: "\n".join(line.format(rng.randrange(2)) for _ in range(3)) for i in range(60)}
    texts |= {i: line.format("x") for i in (1, 2, *range(10, 16))}
    digests = lambda df, **k: {r["doc_id"]: (r["n_dropped"], r["kept_sha256"]) for r in line_dedup.digest(line_dedup.drop_repeated_lines(df, **k)).collect()}
    now = set(range(10, 16))
    refs = line_dedup.count_lines(frame(now), shards=4)
    for added, removed in (({1, 2}, set()), ({30, 31, 32, 5, 6, 7, 8}, {15}), (set(), {14, 32, 30}), ({3, 50, 51}, {13, 1, 50})):
        held = line_dedup.line_holders(frame(now))
        refs = line_dedup.update_counts(refs, frame(added) if added else None, frame(removed) if removed else None, held)
        refs = spark.createDataFrame(refs.collect(), refs.schema)
        now = (now | added) - removed
        batch = digests(frame(now))
        some = set(rng.sample(sorted(now), 5)) | (added - removed)
        assert digests(frame(some), refs=refs) == {i: batch[i] for i in some}
    assert sum(v[0] > 0 for v in batch.values()) > 3


def test_cuckoo_filter_inserts_and_deletes():
    rng = np.random.default_rng(0)
    k = rng.integers(-(1 << 62), 1 << 62, (5000, 2))
    f = line_dedup.CuckooFilter.of(k[:4000, 0].copy(), k[:4000, 1].copy())
    assert f.contains(k[:4000, 0], k[:4000, 1]).all() and f.contains(k[4000:, 0], k[4000:, 1]).mean() < 0.01
    f = line_dedup.CuckooFilter.from_bytes(f.to_bytes())
    f.delete(k[:2000, 0], k[:2000, 1])
    assert f.contains(k[2000:4000, 0], k[2000:4000, 1]).all() and f.contains(k[:2000, 0], k[:2000, 1]).mean() < 0.01


# 8 sharding


def _jump_by_hand(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding_holds_the_key_law(spark, docs):
    from scholarlake.llm.common import mix

    rows = sharding.assign_shards(docs, 8).collect()
    assert len(rows) == len(TEXTS)
    slots = {}
    for r in rows:
        raw = (TEXTS[r["doc_id"]] or "").encode()
        key = int(mix(np.array([r["doc_id"]], np.int64).view(np.uint64))[0])
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (_jump_by_hand(key, 8), _jump_by_hand(key, 9))
        assert r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_stay_gapless_with_nulls_and_repeats(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), (5, "b"), (5, "b"), (6, "")], "doc_id long, text string")
    slots = {}
    for r in sharding.assign_shards(df, 3).collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# 9 quality


def test_classifier_learns_scores_and_ignores_ids(spark):
    rng = random.Random(0)
    from .fixtures import prose

    texts = [prose(rng, 80) if i % 4 else prose(rng, 60).upper().replace(" ", "!! ") for i in range(800)] + [None, "", "x" * 300_000]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(800)] + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(rows) == 803 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [(rows[i]["score"], i % 4 > 0) for i in range(800) if rows[i]["held_out"]]
    good, bad = [s for s, g in held if g], [s for s, g in held if not g]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept == {i for i, r in rows.items() if r["predicted"]}


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    texts = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (0, 1, 247, 248, 249, 256, 511, 5000)]
    net = quality.ByteConvNet()
    net.trained = True
    offs = np.cumsum([0, *map(len, texts)])
    together = net.score(np.frombuffer(b"".join(texts), np.uint8), offs)
    alone = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def _plain_features(net, text: bytes) -> np.ndarray:
    """Mean and maximum over chunks of the largest filter responses, window by window."""
    data = np.frombuffer(text + bytes(quality.HALF + quality.WIDTH), np.uint8)
    n = max(1, -(-(len(text) + quality.WIDTH) // quality.HALF))
    halves = np.zeros((n, quality.FILTERS))
    for h in range(n):
        for at in range(h * quality.HALF, (h + 1) * quality.HALF, quality.STEP):
            if at + quality.WIDTH <= n * quality.HALF:  # the window that would leave the layout counts as 0
                x = net.p["bytes"][data[at : at + quality.WIDTH]].astype(float).ravel()
                halves[h] = np.maximum(halves[h], x @ net.p["filters"].astype(float) + net.p["shift"])
    chunks = np.array([np.maximum(halves[i], halves[min(i + 1, n - 1)]) for i in range(max(1, n - 1))])
    return np.concatenate([chunks.mean(0), chunks.max(0)])


def test_forward_pass_and_gradient_equal_plain_ones(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (0, 3, 300, 900, 2000, 700)]
    labels = np.array([0.0, 1, 1, 0, 1, 0])
    net = quality.ByteConvNet()
    net.trained = True

    def loss() -> float:
        p = np.array([1 / (1 + np.exp(-(_plain_features(net, t) @ net.p["out"].astype(float) + float(net.p["bias"][0])))) for t in texts])
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    offs = np.cumsum([0, *map(len, texts)])
    got = net.score(np.frombuffer(b"".join(texts), np.uint8), offs)
    want = [1 / (1 + np.exp(-(_plain_features(net, t) @ net.p["out"] + net.p["bias"][0]))) for t in texts]
    assert np.allclose(got, want, atol=1e-5)
    # one step of training moves each parameter against its numerical gradient
    before = {k: v.copy() for k, v in net.p.items()}
    monkeypatch.setattr(quality, "EPOCHS", 1)
    net.p["bias"][:] = np.log(labels.mean() / (1 - labels.mean()))
    before["bias"] = net.p["bias"].copy()
    net.fit(texts, labels)
    step = {k: net.p[k] - before[k] for k in before}
    net.p = {k: v.astype(float) for k, v in before.items()}
    for k, places in {"bias": [(0,)], "out": [(0,), (17,), (31,)], "shift": [(1,), (9,)], "filters": [(5, 3), (40, 12)], "bytes": [(65, 2), (100, 7)]}.items():
        for at in places:
            e, old = 1e-5, net.p[k][at]
            net.p[k][at] = old + e
            up = loss()
            net.p[k][at] = old - e
            slope = (up - loss()) / (2 * e)
            net.p[k][at] = old
            if abs(slope) > 1e-5:
                assert np.sign(step[k][at]) == -np.sign(slope), (k, at)


def test_sample_is_taken_from_labels_that_have_documents(spark):
    rng = random.Random(3)
    texts = [prose(rng, 60) if i % 2 else prose(rng, 60).upper().replace(" ", "!! ") for i in range(200)]
    texts[7] = " ".join(prose(rng, 200) for _ in range(60))  # a long one gives windows
    assert len(texts[7].encode()) > quality.MAX_TRAIN_BYTES and len(quality.windows_of(texts[7].encode(), quality.MAX_TRAIN_BYTES)) == 4
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(10_000 + i, 1) for i in range(20_000)], "doc_id long, quality int")
    net = quality.train(documents(spark, texts), labels, max_sample=60)
    assert net.trained


def test_no_labels_give_even_scores(spark):
    docs = documents(spark, ["a", None])
    assert [r["score"] for r in quality.classify(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()] == [0.5, 0.5]


# 10 nearest


def test_nearest_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(400, 16)).astype(np.float32)
    v[100:140] = v[100]
    rows = {i: x.tolist() for i, x in enumerate(v)}
    bad = [(900, None), (920, [0.0] * 16), (940, [1.0, None] * 8), (960, [float("nan")] * 16), (980, [float("inf")] * 16), (1000, []), (1020, [1.0, 2.0]), (1021, [2.0, 1.0]), (None, [1.0] * 16)]
    rows |= {1020: [1.0, 2.0], 1021: [2.0, 1.0]}
    data = [(i, x, 0) for i, x in rows.items() if i < 900] + [(i, x, 0) for i, x in bad] + [(7, rows[7], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, dim int").repartition(3)
    want = nearest.brute_force(rows)
    for batch, every in ((nearest.BATCH_BYTES, nearest.FLOOR_EVERY), (1500, 3)):  # one broadcast, and several with floors
        monkeypatch.setattr(nearest, "BATCH_BYTES", batch)
        monkeypatch.setattr(nearest, "FLOOR_EVERY", every)
        monkeypatch.setattr(nearest, "QUERY_ROWS", 8)
        monkeypatch.setattr(nearest, "BLOCK_ROWS", 64)
        got = sorted(map(tuple, nearest.nearest(df).collect()))
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    assert nearest.nearest(df.limit(0)).count() == 0


def test_wide_vectors_stay_inside_their_bounds(spark):
    rng = np.random.default_rng(1)
    v = rng.integers(-3, 4, (300, 4096)).astype(float)
    v[:, 0] = 127 * 3
    q, c = nearest.Codes(v[:40]), nearest.Codes(v)
    est, err = nearest.tile_bounds(q, c)
    assert (np.abs(v[:40] @ v.T - est) <= err).all()
    rows = {i: x.tolist() for i, x in enumerate(v[:120])}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    assert sorted(map(tuple, nearest.nearest(df, 5).collect())) == nearest.brute_force(rows, 5)


# empty tables and repeated rows


def test_dealt_join_equals_plain_join_and_broadcasts_few_keys(spark):
    rows = spark.range(6000).selectExpr("case when id % 3 = 0 then 7 when id % 3 = 1 then id else null end as key", "id as x")
    other = spark.createDataFrame([(7, "hot"), (1, "one"), (4, "four"), (5, "none"), (None, "null")], "key long, y string")
    for how in ("inner", "left"):
        found = common.dealt_join(rows, other, ["key"], ["x"], how=how)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, rows.join(other, "key", how).collect()), key=str)
    shares = 4 * common.shuffles(spark)
    hot, total = common.hot_keys(rows.groupBy("key").count().withColumnRenamed("count", "k"), ["key"], shares), 6000
    assert {(r["key"], r["_parts"]) for r in hot.collect()} == {(None, -(-2000 * shares // total)), (7, -(-2000 * shares // total))}
    even = spark.range(500).selectExpr("id as key", "1L as k")
    assert common.hot_keys(even, ["key"], shares).count() == 1  # always one, and it has one part
    assert common.hot_keys(even.limit(0), ["key"], shares).count() == 0
    assert common.dealt_join(rows.limit(0), other, ["key"], ["x"]).count() == 0


def test_empty_tables(spark):
    docs = documents(spark, ["a"]).limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert substring_dedup.dedup_substrings(docs).count() == 0
    assert token_output.read_documents(token_output.write_ids(docs, BPE)).count() == 0
    assert decontamination.contamination(docs, items).count() == 0
    assert decontamination.contamination(documents(spark, TEXTS), items).where("size(hits) > 0").count() == 0
    assert pieces.encode_documents(docs, PIECES).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert line_dedup.drop_repeated_lines(docs).count() == 0
    assert sharding.assign_shards(docs).count() == 0
    assert quality.classify(docs, labels).count() == 0


def test_repeated_rows_and_null_ids(spark):
    text = TEXTS[5]
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "other"), (None, None)], "doc_id long, text string")
    removed = sorted((str(r["doc_id"]), r["n_removed"]) for r in substring_dedup.digest(substring_dedup.dedup_substrings(df)).collect())
    n = len(text.encode())
    assert removed == [("1", n), ("1", n), ("2", 0), ("None", 0), ("None", n)]
    assert token_output.read_documents(token_output.write_ids(df, BPE)).count() == 5
    near = sorted(str(r["component_id"]) for r in near_dedup.near_duplicates(df).collect())
    assert near == ["1", "1", "2", "None", "None"]
    assert line_dedup.drop_repeated_lines(df).count() == 5
    assert decontamination.contamination(df, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 5
    assert pieces.encode_documents(df, PIECES).count() == 5
    assert quality.classify(df, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).count() == 5
