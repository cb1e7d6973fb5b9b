from __future__ import annotations

import datetime
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capturelake.llm import bpe, decontam, langid, neardup, pii, pseudolm, quality, rans, toxicity, urlfilter
from capturelake.llm import text as tx
from capturelake.scratch import Scratch, shared_dir

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, id string, score string, sig string"
ODD = [None, "", " \n\t ", "one", "é x", "a b c d", "x" * 3000, "<|endoftext|> 🙂 ́"]


def docs_of(spark, texts, start=0):
    """A table with extra columns whose names operators use inside."""
    rows = [(start + i, t, "i", "s", "g") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


# words and shingles


def test_words_and_shingles_match_brute_force():
    rng = random.Random(1)
    texts = [*ODD[1:], *("".join(rng.choice("ab \n\t\x0bé") for _ in range(rng.randint(0, 60))) for _ in range(200))]
    buf, offs = tx.string_bytes(pa.array([None, *texts]))
    words = tx.Words(buf, offs)
    flat = [w for t in texts for w in WORD.findall(t)]
    assert len(words) == len(flat)
    assert [bytes(buf[a:b]).decode() for a, b in zip(words.start, words.end, strict=True)] == flat
    assert len(set(words.hash.tolist())) == len(set(flat))
    values, bounds = tx.distinct(*tx.shingles(words, len(texts) + 1, 3))
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        want = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
        assert bounds[i + 2] - bounds[i + 1] == len(want)


def test_hash_pieces_do_not_change_hashes(monkeypatch):
    buf, offs = tx.string_bytes(pa.array([" ".join(f"word{i}" for i in range(500)), "x" * 100]))
    whole = tx.Words(buf, offs).hash
    monkeypatch.setattr(tx, "PIECE", 37)
    assert (tx.Words(buf, offs).hash == whole).all()


# 1 and 2: tokens


@pytest.mark.parametrize("n", [1, 31, 32, 33, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK + 5])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50257).astype(np.uint32)
    s = rans.Segment(rans.pack(np.array([3]), np.array([n]), ids, 17))
    assert (s.blocks(0, int(s.head["blocks"])) == ids).all() and int(s.head["first"]) == 17
    last = int(s.head["blocks"]) - 1
    assert (s.blocks(last, last + 1) == ids[last * rans.BLOCK :]).all()


def test_rans_finds_damage():
    raw = bytearray(rans.pack(np.array([3]), np.array([40_000]), np.arange(40_000, dtype=np.uint32) % 500))
    raw[-9] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        rans.Segment(bytes(raw)).blocks(0, 2)
    with pytest.raises(ValueError):
        rans.Segment(b"no")


def test_token_index(spark):
    from tokenizers import Tokenizer

    texts = [*ODD, "a <|endoftext|> b<|endoftext|>", " ".join(f"x{i} é{i}" for i in range(200_000)), *[prose(random.Random(i), 300) for i in range(20)]]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r["id"]: r for r in rans.token_index(docs_of(spark, texts).orderBy(F.desc("doc_id")), path, public_tokenizers.PATTERN).collect()}
    t = Tokenizer.from_file(path)
    at = 0
    for i, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["crc"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert rans.token_index(docs_of(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_equals_ranks(spark):
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(2)
    alphabet = ["a", "b", " ", "-", "=", "é", "\n", "aa", "ch", "0", "日", "🙂", "́", "th", "\t", "'s", "!", "\x1c", " "]
    texts = [*ODD, *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400))]
    df = docs_of(spark, texts)
    ids = {r["id"]: r for r in bpe.encode(df, path, pattern, offsets=True).collect()}
    for i, t in enumerate(texts):
        assert ids[i]["ids"] == enc.encode_ordinary(t or "")
        assert (ids[i]["char_end"] or [0])[-1] == len(t or "") or not t
    back = {r["id"]: r for r in bpe.decode(bpe.encode(df, path, pattern), path, pattern).collect()}
    assert all(bytes(back[i]["bytes"]) == (t or "").encode() and back[i]["text"] == (t or "") for i, t in enumerate(texts))
    trip = {r["doc_id"]: r for r in bpe.round_trip(df, path, pattern).collect()}
    assert all(trip[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts))
    own = bpe.codec((bpe.model_json(bpe.read_ranks(path), pattern), None), pattern)
    split = own.encode("a🙂b")
    assert "".join(own.decode_pieces([split[k : k + 1] for k in range(len(split))])) == "a🙂b"


def test_token_index_repeated_and_null_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None, "n"), (3, "b b b"), (3, "a"), (3, "a"), (1, None), (None, None)]
    got = rans.token_index(spark.createDataFrame(rows, "doc_id long, text string"), path, public_tokenizers.PATTERN).orderBy("start").collect()
    assert [r["id"] for r in got] == [None, None, 1, 3, 3, 3]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    assert sorted(r["n_tokens"] for r in got if r["id"] == 3) == [2, 2, 4]


def test_several_segments(spark, monkeypatch, tmp_path):
    """Files of a partition follow each other; the writer is run here, in the driver's process."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(rans, "SEGMENT", 500)
    monkeypatch.setattr(bpe, "SLICE", 300)
    monkeypatch.setattr(rans.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 2})()))
    texts = [prose(random.Random(i), 60) for i in range(40)]
    source = type("B", (), {"value": (open(path, encoding="utf-8").read(), None)})
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["id", "text"])
    rows = [b.to_pylist()[0] for b in rans._write(source, public_tokenizers.PATTERN, 0, f"file://{tmp_path}")([batch])]
    assert len(rows) > 3 and [r["first"] for r in rows] == np.cumsum([0, *[r["tokens"] for r in rows]])[:-1].tolist()
    t = Tokenizer.from_file(path)
    got = []
    for r in rows:
        s = rans.Segment((tmp_path / f"part-000002-{r['segment']:06d}.rans").read_bytes())
        got += s.blocks(0, int(s.head["blocks"])).tolist()
    assert got == [i for x in texts for i in [*t.encode(x, add_special_tokens=False).ids, 0]]


def test_wide_tables_round_trip():
    ids = np.random.default_rng(1).permutation(np.arange(70_000, dtype=np.uint32))
    s = rans.Segment(rans.pack(np.array([3]), np.array([len(ids)]), ids))
    assert (s.blocks(0, int(s.head["blocks"])) == ids).all()


def test_matches_are_those_of_the_pattern():
    import regex

    from capturelake.llm import split

    find = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    rng = random.Random(8)
    alphabet = ["a", "b", " ", "  ", "-", "'", "'s", "'re", "'ll", "ve", "é", "\n", "\t", "0", "日", "🙂", "́", "\x85", "\xa0", "　", " '", "1²", "½", "\x1c", "ǅ", "!", "re", "l", "ª"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    buf, offs = tx.string_bytes(pa.array(texts))
    start = split.matches(buf, offs, split.regex_classes())
    raw, ends = buf.tobytes(), np.append(start[1:], len(buf))
    assert [raw[a:b].decode() for a, b in zip(start, ends, strict=True)] == [m for t in texts for m in find(t)]


def test_codec_forgets_and_follows_other_patterns(monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "KEPT", 40)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks, rng = bpe.read_ranks(path), random.Random(9)
    for pattern in (public_tokenizers.PATTERN, r"\p{L}+|\P{L}"):
        own = bpe.Codec(bpe.model_json(ranks, pattern), pattern)
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for _ in range(20):
            texts = [None, "", *("".join(rng.choice("ab é\n'") for _ in range(30)) for _ in range(3))]
            ids, at = own.encode_column(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [enc.encode_ordinary(t or "") for t in texts]


def test_bpe_of_no_rows_repeated_rows_and_very_long_texts(spark):
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    assert bpe.round_trip(docs_of(spark, []), path, pattern).count() == 0 and bpe.encode(docs_of(spark, []), path, pattern).count() == 0
    long = " ".join(f"wörd{k % 9000} x{k}" for k in range(400_000))
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, long)]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), path, pattern).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == [(-1, 1), (1, 2), (1, 2), (2, len(want := enc.encode_ordinary(long)))]
    (r,) = [r for r in got if r["doc_id"] == 2]
    assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(long.encode()).hexdigest()


# 3: quality


@pytest.mark.parametrize("hashed", ["xxhash64({})", "length(concat({})) % 3"])
def test_quality_matches_brute_force(spark, monkeypatch, hashed):
    """Also with a hash that most windows share."""
    monkeypatch.setattr(quality, "HASH", hashed)
    rng = random.Random(3)
    texts = [*ODD, "a a\x01 b a b c", "x y z " * 30, " ".join(f"w{k % 70_000}" for k in range(70_100)) if "xx" in hashed else "", *("".join(rng.choice(["a ", "b ", "c ", "d\n", "#", "!", "É ", "\n", " \n"]) for _ in range(rng.randint(0, 150))) for _ in range(150))]
    got = {r["id"]: r for r in quality.measured(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        wins = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        many = Counter(wins)
        covered = {k + j for k, x in enumerate(wins) if many[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want


def test_quality_cases(spark):
    df = spark.createDataFrame([(None, "a b", 1), (2, "a b", 2), (2, "a b", 3)], "doc_id long, text string, words int")
    assert sorted((r["id"] or -1, r["n_words"], r["fail_bits"]) for r in quality.ledger(df).collect()) == [(i, 2, quality.BITS["few_words"] | quality.BITS["word_length"]) for i in (-1, 2, 2)]
    assert quality.ledger(df.limit(0)).count() == 0 and quality.ablation(quality.ledger(df.limit(0))).where("rejected > 0").count() == 0


def test_ablation(spark):
    led = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "fail_bits long")
    got = {r["rule"]: r for r in quality.ablation(led, {"p": ("few_words", "repeated_words")}).collect()}
    few, rep = got["few_words"], got["repeated_words"]
    assert (few["rejected"], few["without_rule"], few["only_by_rule"], few["also_failed"]) == (3, 1, 2, 3)
    assert (rep["rejected"], rep["without_rule"], rep["only_by_rule"]) == (3, 3, 0)
    assert led.where(quality.verdict("base")).count() == 2


# 4: decontamination


def test_decontamination(spark):
    rng = random.Random(4)
    items = [prose(rng, n, 5000) for n in (14, 30, 45, 60)] + ["one two three", None, ""]
    edited = items[3].split()
    edited[30] = "changed"
    texts = [
        *ODD,
        prose(rng, 200, 5000),
        f"{prose(rng, 70, 5000)} {items[1].upper()} {prose(rng, 50, 5000)}",
        "### ".join(items[0].split()),
        " ".join(edited),
        f"{prose(rng, 5)} One, two; THREE! {prose(rng, 5)}",
        " ".join(items[2].split()[:25]),
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = docs_of(spark, texts)
    got = {(r["id"], r["item"]): r for r in decontam.contaminated(df, bench).collect()}
    n = len(ODD)
    assert set(got) == {(n + 1, 1), (n + 2, 0), (n + 3, 3), (n + 4, 4)}
    assert got[n + 1, 1]["first_word"] == 70 and got[n + 1, 1]["similarity"] == 1.0
    assert 0.8 <= got[n + 3, 3]["similarity"] < 0.9
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in got}
    assert decontam.clean(df, bench.limit(0)).count() == len(texts) and decontam.clean(df.limit(0), bench).count() == 0


def test_block_tables_find_all_within_the_radius():
    rng = random.Random(5)
    items = decontam.Items(list(range(40)), [prose(rng, 20, 3000) for _ in range(40)], 5, 0.8)
    prints = np.array([int(items.print[rng.randrange(40)]) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 26))) for _ in range(500)], np.uint64)
    w, i = items.candidates(prints, items.tables(np.arange(40)))
    want = {(a, b) for a in range(500) for b in range(40) if int(prints[a] ^ items.print[b]).bit_count() <= decontam.RADIUS}
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == want


def similar_windows(texts, items, least):
    """Every (text, item) with a window of the item's words at least that similar, from the definition."""
    words = lambda t: "".join(c for c in (t or "") if c not in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower().split()
    grams = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter({tuple(w): 1})
    own = {i: words(x) for i, x in enumerate(items) if words(x)}
    spread = Counter(g for w in own.values() for g in grams(w))
    weight = lambda g: 1 + np.log((1 + len(own)) / (1 + spread[g]))
    out = {}
    for d, t in enumerate(texts):
        w = words(t)
        for i, x in own.items():
            if len(x) < 5 and len(w) >= len(x):
                best = 1.0 if any(w[k : k + len(x)] == x for k in range(len(w) - len(x) + 1)) else 0.0
            else:
                best, y = 0.0, grams(x)
                for k in range(max(1, len(w) - len(x) + 1)):
                    z = grams(w[k : k + len(x)])
                    low = sum(min(z[g], y[g]) * weight(g) for g in z)
                    best = max(best, low / (sum(n * weight(g) for g, n in z.items()) + sum(n * weight(g) for g, n in y.items()) - low))
            if best >= least:
                out[d, i] = best
    return out


@pytest.mark.parametrize("most", [20_000, 4])
def test_decontamination_matches_brute_force(spark, monkeypatch, most):
    """In one block of items and in several; with ties, repeated rows and null ids."""
    monkeypatch.setattr(decontam, "MOST_ITEMS", most)
    rng = random.Random(40)
    common = prose(rng, 12, 5000)
    items = [f"{prose(rng, rng.randrange(8, 30), 5000)} {common if i % 3 == 0 else ''} {prose(rng, 10, 5000)}" for i in range(14)]
    items += [items[0], None, "", "few words here", common]
    texts = [*ODD]
    for i, x in enumerate(items):
        w = (x or "").split()
        for _ in range(4):
            edited = list(w)
            for _ in range(rng.randrange(0, 3)):
                if edited:
                    edited[rng.randrange(len(edited))] = f"e{rng.randrange(9)}"
            texts.append(" ".join([*prose(rng, rng.randrange(0, 40), 5000).split(), *edited, *prose(rng, rng.randrange(0, 40), 5000).split()]))
    texts += [f"{items[2]} and {items[2]}", " ".join([items[4]] * 300), texts[-1]]
    df = spark.createDataFrame([(None if i == 9 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, x, i) for i, x in enumerate(items)], "item_id long, text string, id long")
    got = {(9 if r["id"] is None else r["id"], r["item"]): r["similarity"] for r in decontam.contaminated(df, bench).collect()}
    want = similar_windows(texts, items, 0.8)
    # SimHash may miss what is hardly similar enough
    clear = {k for k, s in want.items() if s >= 0.85}
    assert clear <= set(got) <= set(want) and len(set(want) - set(got)) <= 1 and len(clear) > 30
    assert all(got[k] == pytest.approx(want[k], rel=1e-5) for k in got)
    kept = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in decontam.clean(df, bench).collect())
    assert kept == sorted(-1 if i == 9 else i for i in range(len(texts)) if i not in {d for d, _ in got})


def test_decontamination_of_a_very_long_text(spark):
    rng = random.Random(41)
    item = prose(rng, 40, 5000)
    long = f"{prose(rng, 150_000, 5000)} {item} {prose(rng, 150_000, 5000)}"
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r["id"], r["first_word"]) for r in decontam.contaminated(docs_of(spark, [long]), bench).collect()] == [(0, 150_000)]


# 5: language


def test_language(spark):
    rng = random.Random(6)
    sets = {"aa": ["lolo", "lalo", "lula"], "bb": ["krak", "krik", "trak"], "cc": ["suse", "sise", "zusi"]}
    rows = [(i, " ".join(rng.choice(sets[k]) for _ in range(30)), k) for i in range(150) for k in [sorted(sets)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.LanguageId(spark).fit(df, F.expr("id < 120"))
    got = {r["id"]: r for r in model.predict(df).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows) and all(0 <= r["score"] <= 1 for r in got.values())
    odd = {r["id"]: r["lang_pred"] for r in model.predict(docs_of(spark, [None, "", "12 !?", "krak"])).collect()}
    assert odd == {0: "und", 1: "und", 2: "und", 3: "bb"}
    assert langid.LanguageId(spark).fit(df.limit(0), F.lit(True)).predict(df).where("lang_pred <> 'und'").count() == 0
    assert model.model.value.sparsity > 0.9


def test_language_cases(spark):
    """Null and repeated ids, more rows than are wanted, rare languages, repeated rows."""
    rng = random.Random(16)
    rows = [(i, " ".join(rng.choice(["lolo", "lalo", "lula"]) for _ in range(9)), "aa") for i in range(400)]
    rows += [(7, "krak krik", "bb"), (7, "krak krik", "bb"), (8, "trak krak", "bb"), (None, "zzz", "zz"), (9, None, "cc"), (10, "suse", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.LanguageId(spark, per_lang=50).fit(df, F.lit(True))
    assert model.model.value.langs == ["aa", "bb"]
    got = model.predict(df).collect()
    assert len(got) == len(rows) and Counter(r["lang_pred"] for r in got)["und"] == 1
    assert {r["lang_pred"] for r in got if r["id"] in (7, 8) and r["lang_pred"] != "aa"} == {"bb"}
    long = {r["id"]: r["lang_pred"] for r in model.predict(docs_of(spark, ["krik trak " * 150_000, "lolo" * 400_000])).collect()}
    assert long == {0: "bb", 1: "aa"}


def test_language_features_do_not_depend_on_pieces(monkeypatch):
    """With and without spaces at the cuts; every n-gram once."""
    rng = random.Random(17)
    texts = ["abc def ghij klmnopqrstuvwxyz a", "12", "  ", "x", "Straße, 日本 İx 𝔸b!!c ", *("".join(rng.choice("ab  1É日") for _ in range(rng.randrange(0, 60))) for _ in range(200))]
    whole = [sorted(np.concatenate([*langid.features(t), np.zeros(0, np.uint32)]).tolist()) for t in texts]
    for t, found in zip(texts, whole, strict=True):
        s = " ".join("".join(c if c.isalpha() else " " for c in t).split())
        n = len(s) + 2
        assert len(found) == (len(s.replace(" ", "")) + n - 1 + n - 2 if s else 0)
    for size in (1, 2, 3, 10):
        monkeypatch.setattr(langid, "PIECE", size)
        assert [sorted(np.concatenate([*langid.features(t), np.zeros(0, np.uint32)]).tolist()) for t in texts] == whole


# 6: personal data


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms(spark):
    texts = [
        *ODD,
        "card 4845168114407329, again 4845-1681-1440-7329; other 9807915762804490",
        "born 1999-12-31 or 31.12.1999, not 2023-02-30; ssn 123-45-6789, not 666-45-6789",
        "ip 10.0.0.1 not 300.1.1.1, v1.2.3.4.5; +1 (415) 555-2671 and +1 (415) 555-2671",
        "Mail réa.b1@mail9.example.com### and RÉA.B1@MAIL9.EXAMPLE.COM",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "w17 4845168114407329",
    ]
    got = {r["id"]: r for r in pii.pseudonymise(docs_of(spark, texts)).collect()}
    for i, t in enumerate(ODD):
        assert got[i]["text"] == t and got[i]["found"] == []
    a, b, c, d, e, f = (got[len(ODD) + k]["text"] for k in range(6))
    one, two, kept = re.match(r"card (\d{16}), again ([\d-]{19}); other (\d{16})$", a).groups()
    assert luhn(one) and two.replace("-", "") == one and one != "4845168114407329" and kept == "9807915762804490"
    m = re.match(r"born (\d{4}-\d\d-\d\d) or (\d\d)\.(\d\d)\.(\d{4}), not 2023-02-30; ssn (\d{3}-\d\d-\d{4}), not 666-45-6789$", b)
    assert m[1] == f"{m[4]}-{m[3]}-{m[2]}" != "1999-12-31" and datetime.date.fromisoformat(m[1]) and m[5] != "123-45-6789"
    assert re.match(r"ip (?!10\.0\.0\.1 )\d+\.\d+\.\d+\.\d+ not 300\.1\.1\.1, v1\.2\.3\.4\.5; (\+1 \(\d{3}\) \d{3}-\d{4}) and \1$", c) and "555-2671" not in c
    assert "réa" not in d and d.count("mail9.example.com###") == 1 and "@MAIL9.EXAMPLE.COM" in d
    assert re.match(r'token = "(?!04db)[0-9a-f]{40}"$', e)
    assert f == f"w17 {one}"
    assert pii.pseudonymise(docs_of(spark, texts), key="other").where(F.col("id") == len(ODD)).first()["text"] != a


def test_pseudonyms_link_all_ways_to_write_a_value(spark):
    """Equal links and equal pseudonyms, whatever the separators; runs of groups; IPv6."""
    texts = [
        "4845168114407329 or 4845-1681-1440-7329 or 4845 1681 1440 7329",
        "1999-12-31, 31.12.1999, 31/12/1999",
        "+14155552671 +1 415 555 2671 (415) 555-2671 415-555-2671",
        "+442071838750 +44 20 7183 8750",
        "2001:db8::ff00:42:8329 2001:0DB8:0:0:0:ff00:0042:8329",
        "a1@b.org A1@B.ORG",
        "0000 4845 1681 1440 7329",
        "4845 1681 1440 7329 4845 1681 1440 7329 1111",
        "12:30:45 std::vector ab::cd 1:2:3 0000 0000 0000 0000",
        "fe80::1. ::1:2 and the loopback ::1",
    ]
    df = spark.createDataFrame([(i, t, f"m{i}", f"d{i}", "k") for i, t in enumerate(texts)], "doc_id long, text string, matches string, done string, key string")
    out = pii.pseudonymise(df, key="k1", keep=["matches", "done", "key"])
    got = {r["id"]: r for r in out.collect()}
    assert out.columns == ["id", "text", "found", "matches", "done", "key"] and got[3]["matches"] == "m3" and got[3]["key"] == "k"
    for i, n in ((0, 3), (1, 3), (2, 4), (3, 2), (4, 2), (5, 2)):
        assert len(got[i]["found"]) == n and len({f["link"] for f in got[i]["found"]}) == 1, i
    plain = lambda x: re.sub("[^0-9]", "", x)
    assert len({plain(f["now"]) for f in got[0]["found"]}) == 1
    a, b, c = (f["now"] for f in got[1]["found"])
    assert b == c.replace("/", ".") and a == "-".join(reversed(b.split(".")))
    assert len({plain(f["now"])[-10:] for f in got[2]["found"]}) == 1 and got[2]["text"].startswith("+1") and "555" not in got[2]["text"][:12]
    assert len({plain(f["now"]) for f in got[3]["found"]}) == 1 and got[3]["text"].startswith("+44")
    assert len({f["now"] for f in got[4]["found"]}) == 1 and got[4]["found"][0]["now"].count(":") == 7 and "db8" not in got[4]["text"]
    card = got[0]["text"].split()[0]
    grouped = " ".join(card[k : k + 4] for k in range(0, 16, 4))
    assert got[6]["text"] == f"0000 {grouped}" and got[6]["found"][0]["link"] == got[0]["found"][0]["link"]
    assert got[7]["text"] == f"{grouped} {grouped} 1111" and len(got[7]["found"]) == 2
    assert got[8]["text"] == texts[8] and got[8]["found"] == []
    assert len(got[9]["found"]) == 2 and got[9]["text"].endswith(" and the loopback ::1")
    plan = out._jdf.queryExecution().toString()
    assert "k1" not in plan


def test_key_comes_from_a_file_or_is_drawn(spark, tmp_path):
    df = docs_of(spark, ["10.1.2.3"])
    drawn = pii.pseudonymise(df).first()["text"]
    assert drawn == pii.pseudonymise(df).first()["text"] != "10.1.2.3"
    (tmp_path / "key").write_text("from a file\n")
    spark.conf.set("spark.capturelake.pii.keyPath", str(tmp_path / "key"))
    try:
        assert pii.pseudonymise(df).first()["text"] == pii.pseudonymise(df, key="from a file").first()["text"] != drawn
    finally:
        spark.conf.unset("spark.capturelake.pii.keyPath")


def test_addresses_of_128_bits_are_permuted_one_to_one(spark):
    df = spark.createDataFrame([(i, f"2001:db8::{i:x}:{i:x}") for i in range(1, 200)], "doc_id long, text string")
    new = [r["text"] for r in pii.pseudonymise(df).collect()]
    assert len(set(new)) == 199 and all(len(x.split(":")) == 8 for x in new)


def test_pseudonyms_of_very_long_and_no_texts(spark):
    long = " ".join(["w 4845168114407329"] * 30_000)
    (r,) = pii.pseudonymise(docs_of(spark, [long])).collect()
    assert len(r["found"]) == 30_000 and len(r["text"]) == len(long) and "4845168114407329" not in r["text"]
    assert pii.pseudonymise(docs_of(spark, [])).count() == 0


def test_feistel_is_a_permutation(spark):
    n = 7 * 11
    df = spark.range(n).select(pii.feistel(F.lit("k"), "x", F.floor(F.col("id") / 11), F.col("id") % 11, F.lit(7), F.lit(11)).alias("p"))
    assert len({tuple(r["p"]) for r in df.collect()}) == n


# 7: url filters


def test_url_filters_match_brute_force(spark):
    rng = random.Random(7)
    day = lambda k: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=k)
    hosts, paths = ["a.com", "x.a.com", "b.org", "c.b.org"], ["", "/p", "/p/q", "/pp"]
    patterns = ["a.com", "x.a.com", "b.org/p", "org", "a.com/p", "c.b.org/p/q"]
    entries = [(rng.choice(patterns), rng.choice(["block", "allow", "lift"]), day(rng.randrange(30))) for _ in range(40)]
    caps = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}?z=1", day(rng.randrange(35))) for i in range(200)] + [(900, None, day(1)), (901, "http://a.com/", None), (902, "nonsense", day(3))]
    strength = {"block": 2, "allow": 1, "lift": 0}

    def want(url, at):
        m = re.match(r"http://([^/?]*)([^?]*)", url or "")
        if not m or at is None:
            return False
        best = (-1, -1, None)
        for p in set(patterns):
            h, slash, rest = p.partition("/")
            rest = slash + rest
            if (m[1] == h or m[1].endswith("." + h)) and (not rest or m[2] == rest or m[2].startswith(rest + "/")):
                past = [(t, strength[a], a) for q, a, t in entries if q == p and t <= at]
                if past and max(past)[2] != "lift":
                    best = max(best, (len(h), len(rest), max(past)[2]))
        return best[2] == "block"

    df = spark.createDataFrame(caps, "page_id long, url string, fetched_at timestamp_ntz")
    listed = spark.createDataFrame([*entries, (None, "block", day(1)), ("a.com", "what", day(1)), ("a.com", "block", None)], "pattern string, action string, at timestamp_ntz")
    for small in (urlfilter.SMALL, 0):
        urlfilter.SMALL, old = small, urlfilter.SMALL
        got = {r["id"]: r["blocked"] for r in urlfilter.judge(df, listed).collect()}
        urlfilter.SMALL = old
        assert got == {i: want(u, t) for i, u, t in caps}


def test_url_filter_cases(spark):
    """Empty tables, repeated captures and entries, extra columns, deep paths; both ways to join."""
    day = datetime.datetime(2024, 1, 1)
    deep = "http://a.b.c.example.org/" + "/".join(["p"] * 3000)
    caps = spark.createDataFrame([(1, deep, day, "k"), (1, deep, day, "k"), (None, "http://EXAMPLE.org./p", day, "k"), (3, "http://org/x", day, "k"), (4, "", day, "k")], "page_id long, url string, fetched_at timestamp_ntz, key string")
    listed = spark.createDataFrame([("example.org/p/p/", "block", day), ("example.org/p/p/", "block", day), ("org", "allow", day)], "pattern string, action string, at timestamp_ntz")
    for small in (urlfilter.SMALL, 0):
        urlfilter.SMALL, old = small, urlfilter.SMALL
        got = sorted((r["id"] or -1, r["blocked"], r["pattern"]) for r in urlfilter.judge(caps, listed).collect())
        none = urlfilter.judge(caps, listed.limit(0)).where("blocked or pattern is not null").count()
        empty = urlfilter.judge(caps.limit(0), listed).count()
        urlfilter.SMALL = old
        assert got == [(-1, False, "org"), (1, True, "example.org/p/p"), (1, True, "example.org/p/p"), (3, False, "org"), (4, False, None)] and none == empty == 0


# 8: toxicity


def test_toxicity(spark):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(400):
        w = prose(rng, 80).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(80)] = rng.choice(["nasty,", "VILE", "nasty"])
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    rows += [(None, "w1 nasty"), (4, rows[4][1]), (4, "VILE w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5000, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.Toxicity(spark).fit(df, labels, F.expr("id % 5 <> 0"))
    assert model.score(df).count() == 403
    got = {r["id"]: r["score"] for r in model.score(df.where("doc_id < 400 and length(text) > 20")).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in marks if i % 5 == 0]) > 0.95
    odd = [r["score"] for r in model.score(docs_of(spark, [*ODD[:-1], "w3 " * 400_000])).collect()]
    assert len(odd) == len(ODD) and all(0 <= s < 0.5 for s in odd)
    kept = model.keep(df)
    assert kept.columns == df.columns and abs(kept.count() - 301) < 10
    nothing = toxicity.Toxicity(spark).fit(df, labels.limit(0), F.lit(True))
    assert {r["score"] for r in nothing.score(df).collect()} == {0.0} and nothing.keep(df).count() == 403


def test_pii_key_is_not_written(spark):
    """Neither the shared folder nor the plan shows the key; null ids and repeated rows are handled each on its own."""
    key = "0123456789abcdef" * 4
    df = spark.createDataFrame([(1, "card 4111 1111 1111 1111"), (None, "mail a@b.org"), (None, "mail a@b.org"), (1, None)], "doc_id long, text string")
    out = pii.pseudonymise(df, key=key)
    assert key not in out._jdf.queryExecution().toString()
    rows = out.collect()
    assert sorted((r["id"] is None, r["text"] is None) for r in rows) == [(False, False), (False, True), (True, False), (True, False)]
    assert len({r["text"] for r in rows if r["id"] is None}) == 1
    held = shared_dir(spark).removeprefix("file://")
    for folder, _, names in os.walk(held):
        assert "/pii-" not in folder
        for name in names:
            with open(os.path.join(folder, name), "rb") as f:
                assert key.encode() not in f.read()


def test_pair_backs_off_to_the_shared_level_of_a_rare_word():
    """M(b) = 1 and N(a, b) = 20 of 40 in the toxic class alone, discounts 2 and 2."""
    h = np.array([11, 22], np.uint64).view(np.int64)
    words = pa.table({"w": h, "m0": [30, 0], "m1": [30, 1]})
    pairs = pa.table({"u": h[:1], "w": h[1:], "n0": [0], "n1": [20]})
    contexts = pa.table({"u": h[:1], "c0": [40], "c1": [40]})
    model = toxicity.Counts(words, pairs, contexts, 100, [1000, 1000]).model(2.0, 2.0)
    shared = (1 - 0.75) / 2000 + 0.75 * 100 / 2000 / 101
    back = (1 - 28 / 1000) * shared
    want = np.log(18 / 40 + 22 / 40 * back) - np.log(back)
    got = model.ratios(np.array([22], np.uint64), np.array([11], np.uint64))
    assert got == pytest.approx([want], abs=1e-4) and want > 6


def test_labels_of_one_class_only(spark):
    df = spark.createDataFrame([(i, f"text {i}", 1) for i in range(40)], "doc_id long, text string, toxic int")
    model = toxicity.Toxicity(spark).fit(df, df, F.lit(True))
    assert {r["score"] for r in model.score(df).collect()} == {0.0} and model.keep(df).count() == 40


@pytest.mark.parametrize("rare", [False, True])
def test_kneser_ney_matches_brute_force(spark, monkeypatch, rare):
    """Ratios and mass from the definition, counted with sets; rare: second words that follow one word alone."""
    monkeypatch.setattr(toxicity, "DISCOUNTS", ((2.5, 2.0),))
    rng = random.Random(18)
    rows = [(i, prose(rng, 60, 12), i % 2) for i in range(60)]
    if rare:
        rows = [(i, " ".join(f"{x} only{x}" if x in ("w1", "w2") and (y or x == "w2") else x for x in t.split()), y) for i, t, y in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.Toxicity(spark).fit(df, df, F.lit(True))
    unseen = {r["doc_id"] for r in df.where(F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).collect()}
    grams = {0: set(), 1: set()}
    for i, t, y in rows:
        if i not in unseen:
            w = ["^", "^", *t.split()]
            grams[y] |= {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    n = {y: Counter((u, w) for _, u, w in grams[y]) for y in (0, 1)}
    m = {y: Counter(w for _, w in n[y]) for y in (0, 1)}
    words = sorted(m[0] | m[1])
    total = sum(sum(m[y].values()) for y in (0, 1))

    def shared(w):
        s = m[0][w] + m[1][w]
        return max(s - 0.75, 0) / total + 0.75 * len(words) / total / (len(words) + 1)

    def p(y, w, u):
        own = sum(m[y].values())
        back = sum(min(x, 2.5) for x in m[y].values()) / own
        one = max(m[y][w] - 2.5, 0) / own + back * shared(w)
        after = {x: k for (v, x), k in n[y].items() if v == u}
        if not after:
            return one
        return max(after.get(w, 0) - 2.0, 0) / sum(after.values()) + sum(min(k, 2.0) for k in after.values()) / sum(after.values()) * one

    for y in (0, 1):
        for u in ("^", words[0], words[3], "nowhere"):
            assert sum(p(y, w, u) for w in [*words, "unknown"]) == pytest.approx(1)
    text = " ".join([*rng.choices(words, k=200), "unknown", words[0], "unknown"])
    word, before, _ = toxicity.tokens(pa.RecordBatch.from_arrays([pa.array([text])], ["text"]), 0)
    w = text.split()
    want = [np.log(p(1, x, u)) - np.log(p(0, x, u)) for u, x in zip(["^", *w], w, strict=False)]
    assert model.model.ratios(word, before) == pytest.approx(want, abs=1e-5)


# 9: pseudo-likelihood


def plain_score(model, text, counts):
    """The log-probability of a text by plain loops over tokens, from the weights and all counts."""
    p = {k: v.astype(float) for k, v in pseudolm.shaped(model.weights).items()}
    h, tail, _ = pseudolm.hashed(pa.array([text]))
    leaf, _ = model.vocabulary.leaves(h, tail)
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text)]
    total = 0.0
    for k in range(len(leaf)):
        near = [leaf[k + d] if 0 <= k + d < len(leaf) else pseudolm.PAD for d in pseudolm.PLACES]
        hid = np.tanh(p["b"] + sum(p["e"][c] @ p["w"][j * pseudolm.WIDTH : (j + 1) * pseudolm.WIDTH] for j, c in enumerate(near)))
        z = hid @ p["u"] + p["c"]
        x = int(leaf[k])
        kind = x if x < pseudolm.HEADS else pseudolm.HEADS + (x - pseudolm.HEADS) // pseudolm.MEMBERS
        total += z[kind] - np.log(np.exp(z).sum())
        if x >= pseudolm.HEADS:
            g, m = divmod(x - pseudolm.HEADS, pseudolm.MEMBERS)
            z = hid @ p["v"][g] + p["d"][g]
            total += z[m] - np.log(np.exp(z).sum())
            if m >= pseudolm.OWN:
                total += np.log(max(counts[words[k]], 1) / (model.vocabulary.mass[x] + 1))
    return total


def lm_texts():
    rng = random.Random(9)
    return [*ODD, *(" ".join(x for _ in range(20) for x in (f"a{rng.randrange(9)}", "b", "C")) for _ in range(120)), *(prose(rng, 200, 900) for _ in range(30)), "x " * 60_000]


@pytest.mark.parametrize("vocabulary", [40, 20_000])
def test_pseudo_likelihood(spark, monkeypatch, vocabulary):
    """With few words in the vocabulary, most counts are joined."""
    monkeypatch.setattr(pseudolm, "VOCABULARY", vocabulary)
    texts = lm_texts()
    counts = Counter(w.translate({c: c + 32 for c in range(65, 91)}) for t in texts for w in WORD.findall(t or ""))
    df = docs_of(spark, texts)
    model = pseudolm.PseudoLikelihood(spark).fit(df)
    got = {r["id"]: r for r in model.score(df).collect()}
    assert [got[i]["n_tokens"] for i in range(4)] == [0, 0, 0, 1] and got[0]["log_prob"] == 0 and got[len(texts) - 1]["n_tokens"] == 60_000
    for i in (3, 4, 7, 20, 130, 150):
        assert got[i]["log_prob"] == pytest.approx(plain_score(model, texts[i], counts), rel=1e-4)
    new = "neverseen w7 b neverseen"
    assert model.score(docs_of(spark, [new])).first()["log_prob"] == pytest.approx(plain_score(model, new, counts), rel=1e-4)
    t = texts[20]
    shuffled = " ".join(rng_sample(t.split()))
    assert model.score(docs_of(spark, [shuffled])).first()["log_prob"] < got[20]["log_prob"]
    # the probabilities of all words at one place, and of the unseen ones, sum to 1
    near = np.array([[pseudolm.PAD, pseudolm.PAD, 3, 40, 2, pseudolm.PAD]], np.int16)
    each = np.exp([pseudolm.log_probs(pseudolm.shaped(model.weights), np.array([x]), near)[0] for x in range(pseudolm.LEAVES)])
    words = sorted(counts)
    h, tail, _ = pseudolm.hashed(pa.array([" ".join(words)]))
    leaf, _ = model.vocabulary.leaves(h, tail)
    alone, mass = model.vocabulary.alone, model.vocabulary.mass
    total = sum(each[x] * (1 if alone[x] else counts[w] / (mass[x] + 1)) for w, x in zip(words, leaf, strict=True))
    assert total + sum(each[x] / (mass[x] + 1) for x in np.flatnonzero(~alone)) == pytest.approx(1, abs=1e-3)


def rng_sample(words):
    return random.Random(3).sample(words, len(words))


def test_pseudo_likelihood_of_nothing(spark):
    df = docs_of(spark, [])
    assert pseudolm.PseudoLikelihood(spark).fit(df).score(df).count() == 0
    df = docs_of(spark, [None, ""])
    assert [r["log_prob"] for r in pseudolm.PseudoLikelihood(spark).fit(df).score(df).collect()] == [0, 0]


def test_layout_does_not_change_scores(spark):
    """Rows in another order and over other partitions, several shards and rounds; with repeated rows and null ids."""
    texts = lm_texts()[:-1]
    rows = [(i if i % 17 else None, t) for i, t in enumerate([*texts, *texts[:20]])]
    found = []
    for n, turned in ((1, False), (4, True), (61, False)):
        df = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").repartition(n)
        out = pseudolm.PseudoLikelihood(spark, shard=3000).fit(df).score(df)
        found.append(sorted((r["id"] or -1, r["n_tokens"], r["log_prob"]) for r in out.collect()))
    for other in found[1:]:
        assert [x[:2] for x in other] == [x[:2] for x in found[0]]
        assert max(abs(a[2] - b[2]) / max(a[1], 1) for a, b in zip(found[0], other, strict=True)) < 1e-5


def test_training_takes_every_token(monkeypatch):
    learnt = []
    monkeypatch.setattr(pseudolm.Trainer, "step", lambda self, leaf, near: learnt.append((leaf, near)))
    monkeypatch.setattr(pseudolm, "BATCH", 7)
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, pseudolm.LEAVES, n) for n in (0, 1, 30, 3, 50)]
    trainer = pseudolm.Trainer(pseudolm.start(np.ones(pseudolm.LEAVES)))
    for a, b in ((0, 2), (2, 5)):
        trainer.take(np.concatenate(docs[a:b]), np.cumsum([0, *map(len, docs[a:b])]))
    trainer.finish()
    assert np.concatenate([x for x, _ in learnt]).tolist() == np.concatenate(docs).tolist()
    near = np.concatenate([x for _, x in learnt])
    assert near.tolist() == np.concatenate([pseudolm.neighbours(d, np.array([0, len(d)])) for d in docs]).tolist()


def test_gradient():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in pseudolm.start(rng.integers(1, 9, pseudolm.LEAVES).astype(float)).items()}
    leaf, near = rng.integers(0, pseudolm.LEAVES, 40), rng.integers(0, pseudolm.LEAVES + 1, (40, len(pseudolm.PLACES))).astype(np.int16)
    leaf[:10] = rng.integers(0, pseudolm.HEADS, 10)
    g = pseudolm.gradient(p, leaf, near)
    dense = np.zeros_like(p["e"])
    dense[g.pop("at")] = g["e"]
    g["e"] = dense
    group, member = divmod(int(leaf[20]) - pseudolm.HEADS, pseudolm.MEMBERS)
    for k, at in (("w", (13, 4)), ("u", (3, 7)), ("b", (2,)), ("c", (9,)), ("e", (int(near[0, 0]), 3)), ("v", (group, 5, member)), ("d", (group, member))):
        up, down = ({x: v.copy() for x, v in p.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (pseudolm.log_probs(down, leaf, near).mean() - pseudolm.log_probs(up, leaf, near).mean()) / 2e-5
        assert g[k][at] == pytest.approx(slope, rel=1e-3, abs=1e-7)


def test_slopes_of_neighbours_are_summed_at_their_tokens(monkeypatch):
    """What is sorted in a batch grows with its tokens, not with their neighbours, and the sums are those of all places."""
    rng = np.random.default_rng(4)
    leaf = rng.integers(0, 90, 2000).astype(np.int16)
    near = pseudolm.neighbours(leaf, np.array([0, 3, 900, 2000]))[:1990]
    leaf = leaf[:1990]
    p = {k: v.astype(np.float64) for k, v in pseudolm.start(np.ones(pseudolm.LEAVES)).items()}
    lengths, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: lengths.append(len(x)) or argsort(x, *a, **k))
    g = pseudolm.gradient(p, leaf, near)
    assert lengths and max(lengths) < 1.1 * len(leaf)
    dh = rng.standard_normal((len(leaf), pseudolm.HIDDEN))
    at, e = pseudolm._embedded(p, dh, leaf, near)
    want = np.zeros_like(p["e"])
    np.add.at(want, near.ravel(), (dh @ p["w"].T).reshape(-1, pseudolm.WIDTH))
    dense = np.zeros_like(want)
    dense[at] = e
    assert len(set(at.tolist())) == len(at) == len(g["at"])
    assert dense == pytest.approx(want, abs=1e-9)


def test_words_of_all_lengths_have_their_hash():
    """Words are hashed place by place up to SHORT bytes, the rest at once."""
    texts = [" ".join(c * n for n in (1, 2, 15, 16, 17, 18, 40) for c in "aB"), None, "", " \t", "Ab" * 3000, "é" * 9 + " z"]
    buf, offs = tx.string_bytes(pa.array(texts))
    for lower in (True, False):
        words = tx.Words(buf, offs, lower)
        seen = 0
        for row, t in enumerate(texts):
            for w in WORD.findall(t or ""):
                raw = (w.translate({c: c + 32 for c in range(65, 91)}) if lower else w).encode()
                h = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(raw)) + len(raw) * 0xD6E8FEB86659FD93
                assert words.hash[seen] == tx.mix(np.array([h % (1 << 64)], np.uint64))[0] and words.doc[seen] == row
                seen += 1
        assert seen == len(words)


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(2)
    keys = np.unique(tx.mix(rng.integers(0, 1 << 60, 5000).astype(np.uint64)))
    keys = np.concatenate([keys, (np.uint64(0xFFF) << np.uint64(52)) + np.arange(300, dtype=np.uint64)])
    table = tx.Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(tx.mix(keys)) == -1).all() and (tx.Table(keys[:0]).find(keys) == -1).all()


# 10: near duplicates


def components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    rng = random.Random(percent)
    base, texts = prose(rng, 120, 3000).split(), [*ODD, *ODD, "A B c d", "a b C D"]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(3)}"
        texts.append(" ".join(w if rng.random() < 0.7 else w[rng.randrange(6) :]))
    chain = prose(rng, 100, 3000).split()
    texts += [" ".join(chain[k : k + 60]) for k in range(0, 40, 2)]
    texts += [prose(rng, rng.randrange(1, 90), 3000) for _ in range(40)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    df = docs_of(spark, [texts[i] for i in order])
    sets = {}
    for i, o in enumerate(order):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[o] or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    want = components(sets, percent)
    got = {r["id"]: r for r in neardup.near_duplicates(df, percent).collect()}
    assert {i: r["component"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_near_duplicate_cases(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    rows = neardup.near_duplicates(df).collect()
    assert sorted((r["id"] or -1, r["component"] or -1, r["kept"]) for r in rows) == [(-1, -1, True), (-1, -1, True), (2, 2, True), (4, 2, False), (4, 2, False)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Every text of an id counts, whichever is the least."""
    rng = random.Random(30)
    texts = [prose(rng, 120, 3000) for _ in range(12)]
    rows = []
    for k in range(0, 12, 2):
        near = texts[k + 1].split()
        near[50] = "changed"
        rows += [(10 + k, texts[k]), (10 + k, texts[k + 1]), (11 + k, " ".join(near)), (11 + k, None)]
    rows += [(100, texts[0].upper()), (100, texts[6]), (100, texts[6])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["component"] for r in neardup.near_duplicates(df, 85).collect()}
    assert got == {i: (10 if i in (16, 17, 100) else i - i % 2) for i, _ in rows} | {10: 10, 11: 10}
    assert neardup.near_duplicates(df, 85).count() == len(rows)


def test_near_duplicates_of_very_long_texts(spark):
    rng = random.Random(31)
    long = [f"t{rng.randrange(50_000)}" for _ in range(300_000)]
    other = [*long[:20_000], *(f"u{k}" for k in range(20_000)), *long[40_000:]]
    far = [*long[:150_000], *(f"v{k}" for k in range(150_000))]
    got = {r["id"]: r["component"] for r in neardup.near_duplicates(docs_of(spark, [" ".join(x) for x in (long, other, far)]), 85).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_components(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)]
    got = {r["id"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    assert {got[i] for i in range(1, 61)} == {0} and {got[100 + i] for i in range(1, 40)} == {100}
    assert all(got.get(a, a) == got.get(b, b) for a, b in edges)


def test_bars():
    bars = neardup.least_matches(0.85, 1e-6)
    assert bars == sorted(bars) and 80 < bars[-1] < 0.85 * neardup.HASHES
