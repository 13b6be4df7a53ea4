"""Fingerprints, packing, BPE, licence scans and chat formatting."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tellus.llm import bpe, chat, licenses, packing, queries, syncmers
from tests.llm.helpers import LONG, empty, odd, prose, rows, write


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    conv = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "<|im_end|> \\ [INST]"), (2, 0, "user", None),
            (2, None, None, "x"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "a"), (None, 0, "user", "q"),
            (None, 1, "assistant", LONG), (4, 0, "as\nsist\\ant", "<\\|im_start|> <s>"), (5, 0, "assistant", "")]
    c = spark.createDataFrame(conv, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).withColumn("k", F.lit("x"))
    return write(spark, str(tmp_path_factory.mktemp("odd")), documents=odd(spark), conversations=c)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    c = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    return write(spark, str(tmp_path_factory.mktemp("none")), documents=empty(spark), conversations=c)


def same_rows(df, con, sql):
    """The rows of a DataFrame and of DuckDB SQL, whatever their order."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    theirs = [tuple(r[rel.columns.index(c)] for c in names) for r in rel.fetchall()]
    return sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, theirs))


# ---------------------------------------------------------------- op1

def test_syncmers_are_closed_and_context_free(spark):
    texts = [prose(i, 60) for i in range(5)]
    d = spark.createDataFrame([(i, t, "start of it " + t + " end of it") for i, t in enumerate(texts)], "doc_id long, text string, inside string")
    d = syncmers.with_anchors(syncmers.with_anchors(d, "text", "a"), "inside", "b")
    k, s = syncmers.K, syncmers.S
    for r in d.collect():
        words = r.text.split()
        smers = [r0.h for r0 in spark.createDataFrame([(words[i:i + s],) for i in range(len(words) - s + 1)], "w array<string>")
                 .select(F.xxhash64(*[F.xxhash64(F.get("w", F.lit(j))) for j in range(s)]).alias("h")).collect()]
        expect = []
        for i in range(len(words) - k + 1):
            inner = smers[i:i + k - s + 1]
            if min(inner) == inner[0] or (inner[-1] == min(inner) and inner.index(min(inner)) == len(inner) - 1):
                expect.append(i)
        assert [a.pos for a in r.a] == expect
        # the same words inside another text have the same anchors, three words on
        assert {(a.pos + 3, a.hash) for a in r.a} <= {(b.pos, b.hash) for b in r.b}


def test_char_syncmers_are_closed_and_survive_edits(spark):
    """Code points, beyond 16 bits too; texts without white space and short ones keep part of their anchors."""
    r = random.Random(4)
    han = "".join(chr(r.choice([0x4E00, 0x20000]) + r.randrange(500)) for _ in range(300))
    texts = [prose(1, 12), prose(2, 60), han, "x=1;" + "".join(r.choice("abc(){};=") for _ in range(300)), "short", "a" * 20, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    k, s = syncmers.CHAR_K, syncmers.CHAR_S
    for x in syncmers.with_char_anchors(d, "text", "a").collect():
        t = x.text
        units = spark.createDataFrame([(list(t[i:i + s]),) for i in range(len(t) - s + 1)], "c array<string>")
        h = [y.h for y in units.select(F.xxhash64(*[F.xxhash64(F.get("c", F.lit(j))) for j in range(s)]).alias("h")).collect()] if len(t) >= k else []
        expect = []
        for i in range(len(t) - k + 1):
            inner = h[i:i + k - s + 1]
            if min(inner) == inner[0] or inner.index(min(inner)) == k - s:
                expect.append(i)
        assert [a.pos for a in x.a] == (expect or [0] * (t != "")), t
    after = [(0, texts[0]), (1, texts[2]), (2, texts[3]), (3, "y" * 400)]
    for x in syncmers.edited_fingerprints(spark.createDataFrame(after, "doc_id long, text string")).collect()[:3]:
        assert len(x.fp) > 3 and set(x.fp) & set(x.edited_fp)  # half of the text is kept
    one = spark.createDataFrame([(han, han[:150] + "!" + han[151:])], "t string, u string")
    x = syncmers.with_char_anchors(syncmers.with_char_anchors(one, "t", "a"), "u", "b").select(syncmers.likeness(syncmers.hashes(F.col("a")), syncmers.hashes(F.col("b")))).first()
    assert x[0] > 0.7


def test_position_matches_count_the_diagonal(spark):
    t = prose(5, 200)
    a = syncmers.with_anchors(spark.createDataFrame([(1, t)], "doc_id long, text string"), "text", "anchors")
    b = syncmers.with_anchors(spark.createDataFrame([(2, "three more words " + t)], "doc_id long, text string"), "text", "anchors")
    best = syncmers.position_matches(a, b).orderBy(F.desc("matches")).first()
    assert best.diagonal == -3 and best.matches > 20


def test_op1_on_odd_rows(spark, folder, nothing):
    got = queries.op1_closed_syncmers(spark, folder).collect()
    assert len(got) == len(rows())
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    order = [r for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)) if r[0] is not None]
    for i, r in enumerate(order):
        t = r[1] or ""
        if r[0] in (10, 14):  # a repeated id; the last, followed by a null id
            continue
        n = order[i + 1][1] or ""
        c = len(t) // 2
        e = t[:len(t) - c] + n[:c]
        x, = by[r[0]]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
        if e == t:
            assert x.near_edited == 1.0
    t = rows()[-1][1]
    ends = {hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest() for n in ("", prose(3))}
    assert by[14][0].edited_sha256 in ends
    assert by[1][0].fingerprint == by[3][0].fingerprint != "" and by[5][0].fingerprint == by[4][0].fingerprint == ""
    assert queries.op1_closed_syncmers(spark, nothing).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h i j k")], "doc_id long, text string")
    assert syncmers.edited_fingerprints(one).first().edited == "a b c d e fa b c d e "


def test_next_row_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 7)
    ids = random.Random(3).sample(range(-10 ** 12, 10 ** 12), 200)
    d = syncmers.with_next(spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string"), "doc_id", ["text"], "text")
    order = sorted(ids)
    expect = {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
    assert {r.doc_id: r.next_text for r in d.collect()} == expect


@pytest.mark.parametrize("k, s, mark", [(20, 4, 32), (7, 3, 2), (5, 2, 1)])
def test_edited_fingerprints_are_those_of_the_edited_texts(spark, monkeypatch, k, s, mark):
    """Put together from those of its parts, and the parts are not hashed again."""
    monkeypatch.setattr(syncmers, "MARK", mark)
    rng = random.Random(k)
    texts = [r[1] for r in rows()] + [prose(6), "a" * 500, "ab" * 300, "é日𝒳" * 90, "x", "日本", "𝒳𝒴", "", None]
    texts += ["".join(rng.choice("abcé日𝒳 ") for _ in range(rng.choice([n, 8 * n]))) for n in range(80)]
    rng.shuffle(texts)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = syncmers.edited_fingerprints(d, k=k, s=s)
    again = syncmers.with_char_anchors(got, "edited", "b", k, s).withColumn("b", syncmers.hashes(F.col("b")))
    again = syncmers.with_char_anchors(again.join(d, "doc_id"), "text", "a", k, s).withColumn("a", syncmers.hashes(F.col("a"))).collect()
    assert len(again) == len(texts) and all(r.edited_fp == r.b and r.fp == r.a for r in again)
    after = [t or "" for t in texts[1:] + texts[:1]]
    for r in again:
        t = texts[r.doc_id] or ""
        assert r.edited == t[:len(t) - len(t) // 2] + after[r.doc_id][:len(t) // 2]


# ---------------------------------------------------------------- op2

def bins(placed):
    out = collections.defaultdict(list)
    for r in placed:
        out[r.sequence_id].append((r.offset, r.length))
    for b in out.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= packing.CAPACITY
    return out


def test_op2_on_odd_rows(spark, folder, nothing):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    got = queries.op2_best_fit_packing(spark, folder).collect()
    expect = []
    for r in rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), 4096):
            part = ids[p:p + 4096]
            expect.append((r[0], p // 4096, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(expect, key=key)
    bins(got)
    assert queries.op2_best_fit_packing(spark, nothing).count() == 0


def test_sequences_hold_the_ids(spark):
    p = packing.pieces(odd(spark, False), P.path("word_bpe_49k.json"))
    placed = packing.pack(p)
    seqs = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        whole = bytes(seqs[r.sequence_id].ids)
        assert whole[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
        assert len(whole) == 4 * seqs[r.sequence_id].length


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_gapless_and_tight(seed):
    r, counts = random.Random(seed), collections.Counter()
    for _ in range(r.choice([3, 40, 1500])):
        counts[r.choice([r.randint(1, 4096), r.randint(1, 500), r.randint(1366, 2100)])] += r.choice([1, 2, 70])
    steps, n = packing.plan(counts)
    content, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for length, first, items, b0, per, offset in steps:
        for k in range(items):
            ranks[length].append(first + k)
            content[b0 + k // per].append((offset + k % per * length, length))
    assert all(sorted(v) == list(range(counts[x])) for x, v in ranks.items()) and len(content) == n
    for b in content.values():
        at = 0
        for o, x in sorted(b):
            assert o == at
            at += x
        assert at <= 4096 and sum(3 * x > 4096 for _, x in b) <= 2
    # never worse than first fit decreasing
    gaps = []
    for x in sorted(counts.elements(), reverse=True)[:3000]:
        i = next((i for i, g in enumerate(gaps) if g >= x), None)
        gaps.append(4096 - x) if i is None else gaps.__setitem__(i, gaps[i] - x)
    if sum(counts.values()) <= 3000:
        assert n <= len(gaps) * 1.02 + 1


def test_hot_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    d = spark.range(700).select((F.when(F.col("id") % 3 == 0, 1000).otherwise(1 + F.col("id"))).alias("length"), "id")
    got = packing.pack(d).collect()
    assert len(got) == 700 and len({r.id for r in got}) == 700
    bins(got)


def test_word_encoder_equals_the_tokenizer(monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)  # it overflows all the time
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    texts = [prose(4), "It's WE'LL don't! 'quoted' a.b,c;... x", "\x1c\x1d mixed\x1fwords\x85end", "Ünïcode ÀÉÎ ß ΣΑΣ İstanbul J̌", "é é",
             "<|endoftext|> <|startoftext|>", "a" * 3000, "1234 5,678.90", "日本語 テキスト", " nbsp em", "tail.,;:!? ?!", "-. .- ."]
    for t in texts * 2:
        assert enc(t) == tok.encode(t, add_special_tokens=False).ids, t


def test_word_encoder_keeps_packed_ids_and_learns_a_text_larger_than_its_cache(monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    known, new = " ".join(f"known{i}" for i in range(30)), " ".join(f"new{i}, Ünï{i}" for i in range(30))
    for t in [known, known + " " + new, new, ""]:
        assert enc.packed(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert all(type(v) is bytes and len(v) % 4 == 0 for v in enc.cache.values())


# ---------------------------------------------------------------- op10

def test_op10_on_odd_rows(spark, folder, nothing):
    enc = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = queries.op10_byte_bpe(spark, folder).collect()
    expect = []
    for r in rows():
        ids = enc.encode_ordinary(r[1] or "")
        expect.append((str(r[0]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expect)
    assert queries.op10_byte_bpe(spark, nothing).count() == 0


@pytest.mark.parametrize("text", [LONG, "  \n\n  x " * 900, "a1" * 3000, "it's ''s 're " * 500, "é̂ 'll　x" * 700, "!?'s" * 1500, " " * 5000 + "x", "z" * 5000])
def test_safe_pieces_keep_the_ids(text):
    enc = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for size in (50, 1000):
        assert "".join(bpe.safe_pieces(text, size)) == text
        assert bpe.encode_text(enc, text, size) == enc.encode_ordinary(text)


BLANKS = {"spaces": " ", "line feeds": "\n", "mixed": " \n\t\r\u3000\u00a0", "controls": "\x1c\x1f", "ends": "\r\n"}


@pytest.mark.parametrize("blank", BLANKS)
def test_blank_runs_keep_the_ids(blank):
    """Runs that the library can match itself, cut as long ones are."""
    enc = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert P.PATTERN == bpe.SPLIT
    for n in (1, 2, 19, 20, 21, 22, 40, 3001):
        r = (BLANKS[blank] * n)[:n]
        for text in (r, r + "x", "x" + r, "x" + r + "y", "a" + r + "1" + r + "!" + r, r + "'s" + r + "é ", "?" + r + "\x1cz"):
            assert bpe.encode_text(enc, text, 50, 20) == enc.encode_ordinary(text), (blank, n)


@pytest.mark.parametrize("blank", BLANKS)
def test_two_million_blanks(spark, blank):
    enc = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    r = (BLANKS[blank] * 2_000_000)[:2_000_000]
    texts = {"start": r + "word", "middle": "one" + r + "two", "end": "word" + r}
    long = blank != "controls"  # which are no white space to the library
    run = lambda t: enc._encode_single_piece(t.encode())
    rest = lambda t: enc.encode_ordinary(t)
    expect = {"start": run(r[:-1]) + rest(r[-1] + "word"), "middle": rest("one") + run(r[:-1]) + rest(r[-1] + "two"),
              "end": rest("word") + run(r)} if long else {k: rest(t) for k, t in texts.items()}
    d = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    for x in bpe.round_trip(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        assert np.frombuffer(x.ids, "<u4").tolist() == expect[x.doc_id]
        assert bytes(x.decoded).decode() == texts[x.doc_id]


def test_another_pattern_is_not_cut():
    """Its punctuation runs on into line feeds, which the known boundaries would cut."""
    enc = bpe.encoding(P.path("byte_bpe_50k.tiktoken"), r"[^\s\p{L}]+[\r\n]*|\p{L}+|\s+")
    text = "a!\n\n" * 5000
    assert bpe.encode_text(enc, text, 50, 20) == enc.encode_ordinary(text)


def test_encode_and_decode_columns(spark):
    f = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    d = spark.createDataFrame([("a😀", ), (None, )], "t string").select(bpe.encode(F.col("t"), *f).alias("i"))
    assert [bytes(r.b).decode() for r in d.select(bpe.decode(F.col("i"), *f).alias("b")).collect()] == ["a😀", ""]
    # a part of a character decodes to its raw bytes
    one = d.select(F.substring("i", 1, 4).alias("i"), F.substring("i", 5, 4).alias("j")).first()
    enc = bpe.encoding(*f)
    assert enc.decode_bytes(np.frombuffer(one.j, "<u4").tolist()) == "😀".encode()[:len(enc.decode_bytes(np.frombuffer(one.j, "<u4").tolist()))]


# ---------------------------------------------------------------- op8

LICENCE_TEXTS = [
    "Some words. Licensed under the Apache License, Version 2.0.\nMore", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "no licence of note", "My license is mine.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this. One. Two.\nThe above copyright notice and this permission "
    "notice shall be included in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, express.",
    "The software is provided as is, without warranty of any kind.\nThe above copyright notice and this permission notice shall be included in all "
    "copies.\nPermission is hereby granted, free of charge, to any person obtaining a copy", None, "", "a\nb\n" * 5000 + "All rights reserved."]


def test_op8_against_sql(spark, folder, nothing, tmp_path):
    f = write(spark, str(tmp_path), documents=spark.createDataFrame(list(enumerate(LICENCE_TEXTS)), "doc_id long, text string").withColumn("ids", F.lit(1)))
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, f).collect()}
    assert [got[i].licenses for i in range(6)] == ["Apache-2.0", "MIT", "CC-BY-NC", "GPL-3.0", "", ""]
    assert got[6].licenses == "MIT-text" and got[7].licenses == ""  # in order only
    assert got[5].kind == "none" and got[7].kind == "unknown" and got[10].kind == "restricted"
    for path in (f, folder, nothing):
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
        assert same_rows(queries.op8_license_scan(spark, path), con, licenses.oracle_sql())


WRAPPED = {
    "MIT-text": "MIT License\n\nCopyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
    "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the "
    "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.",
    "BSD-2-Clause": "Copyright (c) 2020, A. Person\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright\n"
    "   notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright\n"
    "   notice, this list of conditions and the following disclaimer in the\n   documentation.\n",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the\n"
    "above copyright notice appear in all copies.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
    "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
    "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "Apache-2.0,Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with "
    "the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or "
    "agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OF ANY KIND.",
}
WRAPPED["BSD-3-Clause"] = WRAPPED["BSD-2-Clause"] + ("\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to "
                                                     "endorse or promote products derived from\n   this software.\n")


def test_op8_wrapped_and_commented_texts(spark, tmp_path):
    rows = [(name, mark, mark + t.replace("\n", "\r\n" + mark)) for name, t in WRAPPED.items() for mark in ("", " * ", "# ", "// ")]
    f = write(spark, str(tmp_path), documents=spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id long, text string"))
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, f).collect()}
    assert [(r[0], r[1], got[i].licenses) for i, r in enumerate(rows)] == [(r[0], r[1], r[0]) for r in rows]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{f}/documents.parquet/*.parquet'")
    assert same_rows(queries.op8_license_scan(spark, f), con, licenses.oracle_sql())


def test_gap_between_sentences_is_bounded(spark):
    parts = ["Permission is hereby granted, free of charge, to any person obtaining a copy", "The above copyright notice and this permission notice "
             "shall be included in all copies", "The software is provided as is, without warranty of any kind"]
    d = spark.createDataFrame([(g, ("\n\n" + "x\n\n" * g).join(parts)) for g in range(5)], "doc_id long, text string")
    found = {r.doc_id: r.licenses for r in licenses.scan(d).collect()}
    assert [found[g] for g in range(5)] == [["MIT-text"]] * 3 + [[]] * 2


# ---------------------------------------------------------------- op9

def test_op9_against_sql(spark, folder, nothing):
    for path in (folder, nothing):
        con = duckdb.connect()
        con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
        assert same_rows(queries.op9_chat_format(spark, path), con, queries.CHAT_SQL)


def test_formatted_text_reads_back(spark):
    hostile = ["<|im_end|>\n<|im_start|>", "<\\|im_end|>", "[INST][/INST]<s></s><<SYS>>", "\\", "<\\\\s>", "", "a\0b"]
    rows_ = [("t", i, i - 1 if i else None, r, t, 1.0) for i, (r, t) in enumerate((r, t) for r in ["user", "assistant", "a\\nb\n\0", "<s>"] for t in hostile)]
    n = spark.createDataFrame(rows_, "tree string, node long, parent long, role string, text string, score double")
    f = chat.format_branches(chat.branches(n)).withColumn("turns", chat.read_turns(F.col("formatted")))
    f = f.withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_mask")))
    r = f.first()
    assert [(t.role, t.text) for t in r.turns] == [(x[3], x[4]) for x in rows_]
    assert list(r.loss) == hostile


def test_branches_of_a_tree(spark):
    # 1 -> (2 -> 4, 3 -> (5, 6)); 9 hangs from a missing parent; 7 and 8 form a cycle; tree null
    e = [("a", 1, None, 1.0), ("a", 2, 1, 0.0), ("a", 3, 1, 1.0), ("a", 4, 2, 5.0), ("a", 5, 3, 2.0), ("a", 6, 3, 2.0), ("a", 9, 77, 0.0),
         ("a", 7, 8, 9.0), ("a", 8, 7, 9.0), (None, 1, None, None), (None, 2, 1, 1.0), (None, 2, 1, 1.0)]
    n = spark.createDataFrame([(t, i, p, "user", f"{i}", s) for t, i, p, s in e], "tree string, node long, parent long, role string, text string, score double")
    paths = collections.defaultdict(list)
    for r in chat.branches(n, None).orderBy("pos").collect():
        paths[r.tree, r.branch_rank, r.leaf].append(int(r.text))
    assert dict(paths) == {("a", 1, 4): [1, 2, 4], ("a", 2, 5): [1, 3, 5], ("a", 3, 6): [1, 3, 6], ("a", 4, 9): [9], (None, 1, 2): [1, 2]}
    assert {r.leaf for r in chat.branches(n, 1).collect()} == {4, 2}


def test_long_thread_takes_few_rounds(spark):
    n = spark.range(300).select(F.lit(1).alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
                                F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(1.0).alias("score"))
    assert [r.text for r in chat.branches(n).orderBy("pos").collect()] == [str(i) for i in range(300)]
