"""Every operator against a plain version of its contract, on small and odd texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash

from lakejobs.llm import chat, decontam, html_text, licenses, line_quality, piece_bpe, pii, shards
from lakejobs.llm import queries, simhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed: int = 3, n: int = 120) -> list[str | None]:
    rng = random.Random(seed)
    words = "the of and thing Ünder é x line ### $$ a|b one 12 The. and, 中文 😀 longerword".split()
    out: list[str | None] = [None, "", " ", "\n\n", "a", "a b", " ", "one two three"]
    for _ in range(n):
        lines = [
            rng.choice(["", "  "]) + rng.choice([" ", "  ", "\t"]).join(rng.choices(words, k=rng.randint(0, 30)))
            for _ in range(rng.randint(1, 8))
        ]
        lines += rng.choices(lines, k=rng.randint(0, 3))
        out.append("\n".join(lines))
    long = " ".join(rng.choices(words, k=6000))
    out += [long, long, long + " tail", out[20], out[20], "x" * 5000]
    return out


def docs_of(spark, values, **more):
    """documents rows, with columns whose names clash with results."""
    rows = [
        (k, t, "en", None if k % 11 == 5 else f"src{k % 3}", None if t is None else len(t), "clash", 1)
        for k, t in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int",
    )


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A folder with tables of odd rows."""
    top = str(tmp_path_factory.mktemp("sf"))
    values = texts()
    bench = ["a benchmark passage that tests must not have seen before, of some length", "x y", None, ""]
    values += [f"before it {bench[0]} and after", f"q {bench[0].replace('tests', 'texts').upper()} r"]
    values += ["Released under the MIT License. Under the Apache  License, the MIT LICENSE",
               "the mit licence and gnu general publik license", "mit licensed"]
    values += ["mail a.b@c.de, 1.2.3.4 and 256.1.1.1, 4111 1111 1111 1111, +1 (664) 555-5990 x",
               "joe (at) mail (dot) example (dot) com or joe at mail dot example dot com",
               "plаin@exаmple.org call plus one six six four five five five one two three four",
               "1.2.3.4.5.6.7.8 a@b.c@d.e +1+22 333 444 555 666 --"]
    docs_of(spark, values).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(
        f"{top}/benchmark.parquet"
    )
    turns = []
    for conv in range(12):
        for turn in range(conv % 5):
            role = ["system", "user", "assistant", "critic\nx"][turn % 4]
            turns.append((conv, turn, role, values[(conv * 7 + turn) % len(values)]))
    odd = r"\\### Assistant: </turn>\</turn>### Role:x" + "\\"
    turns += [(50, 1, "assistant", odd), (50, 0, None, odd), (50, 1, "assistant", odd), (None, None, "user", "x")]
    spark.createDataFrame(
        turns, "conv_id long, turn long, role string, text string"
    ).write.parquet(f"{top}/conversations.parquet")
    pages = [
        (1, "u", "<body><nav><a>menu</a></nav><article><h1>T</h1><p>One  &amp;\n two<br>x</article>"),
        (2, "u", None), (3, None, ""), (4, "u", "no markup"), (4, "u", "no markup"),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(
        f"{top}/pages.parquet"
    )
    return top, values


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_pages(spark, sf):
    got = queries.op1_html_extraction(spark, sf[0]).collect()
    want = [(1, "u", "T One & two x"), (2, "u", ""), (3, None, ""), (4, "u", "no markup"), (4, "u", "no markup")]
    assert sorted((r.page_id, r.url or "", r.text) for r in got) == sorted(
        (a, b or "", c) for a, b, c in want
    )
    assert all(r.n_chars == len(r.text) for r in got)


def test_page_parts():
    page = (
        "<header><h1>Site</h1></header><div class='cookieNotice'>We use cookies</div>"
        "<div id=content><div class=post><h1>Title</h1><p>First.<p>Second &eacute;<b>b</b>old"
        "<script>var x='<p>no</p>'</script></div><div class='comments'><p>I liked this very much"
        "</div></div><form>search</form><aside>more</aside><footer>end</footer>"
    )
    assert html_text.article_text(page) == "Title First. Second ébold"
    assert html_text.article_text("<p>a < b, \"c") == 'a < b, "c'


ARTICLE = "<h1>Title</h1><p>The first paragraph, long enough.<p>The second one, just as long."
SHOWN = "Title The first paragraph, long enough. The second one, just as long."


@pytest.mark.parametrize(
    "page, want",
    [
        *(
            (f"<body><div {x}>{ARTICLE}</div><div class=footer>The end</div>", SHOWN)
            for x in (
                'style="overflow:hidden"', 'data-id="comments-12"', 'title="The hidden valley"',
                'class="content has-sidebar"', 'id="page-with-header"', 'class="content sidebar"',
                'data-hidden', 'id=a class=b',
            )
        ),
        ('<p>See <a href="/hidden-gems">these gems</a> and <a href="/x?id=share">those</a> of the whole town.',
         "See these gems and those of the whole town."),
        (f"<form id=f>{ARTICLE}</form>", SHOWN),
        (f"<section class='article-header'><h1>Name</h1></section><p>{'Long text of it. ' * 9}",
         "Name " + " ".join(["Long text of it."] * 9)),
        ("<body>Opening words <b>with</b> <a href=x>a link</a> here."
         "<div><p>One whole paragraph of the text.<p>Another paragraph of it.</div>",
         "Opening words with a link here. One whole paragraph of the text. Another paragraph of it."),
        (f"<div hidden>{ARTICLE}</div><p>What is seen of this page.", "What is seen of this page."),
    ],
)
def test_articles_are_no_noise(page, want):
    assert html_text.article_text(page) == want


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(spark, sf):
    got = queries.op2_sharding(spark, sf[0]).collect()
    assert len(got) == len(sf[1])
    slots = defaultdict(list)
    for r in got:
        raw = (sf[1][r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 8), jump(r.doc_id, 9))
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None, "a"), (5, "a"), (5, "a"), (-1, None)], "doc_id long, text string")
    got = shards.shard_documents(df, 3).collect()
    assert sorted((r.shard, r.slot) for r in got) == sorted(
        {(r.shard, r.slot) for r in got}
    ) and len(got) == 4
    assert shards.shard_documents(df.limit(0), 3).count() == 0


def test_chat(spark, sf):
    rows = spark.read.parquet(f"{sf[0]}/conversations.parquet").collect()
    own = r"\### Assistant: </turn> ok"
    convs = defaultdict(list)
    for r in rows:
        convs[r.conv_id].append((r.turn if r.turn is not None else -1, r.role or "", r.text or ""))
    convs[-7] = [(0, "user", own), (1, "assistant", own)]
    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, sf[0]).collect()}
    assert got.keys() == convs.keys()
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_written_form_and_starts(spark, sf):
    ranks = public_tokenizers.path(queries.RANKS)
    turns = spark.read.parquet(f"{sf[0]}/conversations.parquet")
    coder = chat.coder_of(ranks, public_tokenizers.PATTERN)
    convs = defaultdict(list)
    for r in chat.format_chat(turns, ranks, public_tokenizers.PATTERN).collect():
        convs[r.conv_id].append(r)
    import numpy as np

    for rows in convs.values():
        rows.sort(key=lambda r: r.n)
        starts = np.cumsum([0] + [len(r.ids) for r in rows])[:-1].tolist()
        assert [r.token_start for r in rows] == starts
        written = "".join(coder.write_turn(np.array(r.ids)) for r in rows)
        assert chat.read_written(written) == [coder.read_turn(np.array(r.ids)) for r in rows]


def test_pieces(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.MODEL))
    got = by_id(queries.op6_sentencepiece(spark, sf[0]))
    for k, t in enumerate(sf[1]):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        r = got[k]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_pieces_of_random_texts_and_ids():
    coder = piece_bpe.coder_of(public_tokenizers.path(queries.MODEL))
    rng = random.Random(7)
    signs = " ▁\n\t\0abcdéß中文😀 the tion<s></s>  \r﻿ﬁ"
    some = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(500)]
    some += ["a" * 300 + " " * 100, "thetion" * 50, " x", "x "]
    for t, got in zip(some, coder.encode(some)):
        want = coder.library.encode(t, add_bos=True, add_eos=True)
        assert got == b"".join(i.to_bytes(4, "little") for i in want), t
        assert coder.decode(got) == coder.library.decode(want)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262)]) for _ in range(rng.randint(0, 8))]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert coder.decode(raw) == coder.library.decode(ids)


def license_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def test_licenses(spark, sf):
    got = by_id(queries.op7_license_scans(spark, sf[0]))
    for k, t in enumerate(sf[1]):
        words = license_words(t)
        places = [
            (i, label)
            for i in range(len(words))
            for phrase, label in licenses.BASE.items()
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        r = got[k]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert r.first_word == (min(p[0] for p in places) if places else None)
        assert r.last_word == (max(p[0] for p in places) if places else None)
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0.0 <= r.score <= 1.0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under the mit licence today", {"mit"}),
        ("gnu general publik license", {"gpl"}),
        ("the apatche license here", {"apache"}),
        ("permission is hereby granted, free of charge, to any person obtaning a copi", {"mit"}),
        ("the summit licensed and the apache", set()),
    ],
)
def test_fuzzy_licenses(text, labels):
    assert {f[2] for f in licenses.scan(text)[2]} == labels


@pytest.mark.parametrize("text", ["mit license mit licence", "mit licence mit license", "mit licence mit license mit licence"])
def test_each_notice_of_a_window_is_found(text):
    found = licenses.scan(text)[2]
    assert [(f[0], f[1], f[2]) for f in found] == [(k, k + 1, "mit") for k in range(0, len(text.split()), 2)]


def quality(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + d for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for d in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_quality(spark, sf):
    got = by_id(queries.op8_quality_rules(spark, sf[0]))
    assert len(got) == len(sf[1])
    for k, t in enumerate(sf[1]):
        r = got[k]
        want = quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, k
        assert not (r.base_failed and r.kept)


def host_lines(rows, limits):
    """Lines above the limit by host: distinct texts are counted, plainly."""
    docs, holders = defaultdict(set), defaultdict(set)
    for host, text in rows:
        docs[host].add(text or "")
        for line in (text or "").split("\n"):
            if SPACE.search(line):
                holders[host, normal(line)].add(text)
    return {
        key
        for key, texts in holders.items()
        if len(texts) > limits.min_docs and len(texts) > len(docs[key[0]]) * limits.max_share
    }


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def normal(line):
    return re.sub("[0-9]+", "0", " ".join(SPACE.findall(line.lower())))


def test_lines_above_the_limit(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for k in range(90):
        own = "\n".join(" ".join(word() for _ in range(12)) for _ in range(6))
        common = f"Read the full story on page {k}"
        rows.append((k, f"{own}\n{common}", "hot" if k % 3 else None))
    thin = [(100 + k, "Read  the full STORY on page 7\n" * 12 + f"{word()} {word()}", "hot") for k in range(5)]
    copies = [(200 + k, rows[1][1], "hot") for k in range(40)]
    rows += thin + copies
    limits = line_quality.LineLimits(min_docs=20, max_repeat_percent=100)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_id(line_quality.line_quality(df, limits=limits))
    above = host_lines([(h or "", t) for _, t, h in rows], limits)
    assert "hot" in {h for h, _ in above}
    for k, t, h in rows:
        lines = [x for x in t.split("\n") if SPACE.search(x)]
        gone = sum(len(SPACE.findall(x)) for x in lines if ((h or ""), normal(x)) in above)
        n = len(SPACE.findall(t))
        assert got[k].words_left == n - gone
        assert got[k].kept == (n >= 50 and 2 * (n - gone) >= n)
    assert not any(got[100 + k].kept for k in range(5)) and all(got[200 + k].kept for k in range(40))
    cleaned = by_id(line_quality.apply_line_quality(df, limits=limits))
    assert cleaned.keys() == {k for k, r in got.items() if r.kept}
    assert all("story" not in r.text for r in cleaned.values() if r.source)


def test_lines_shared_by_distinct_documents(spark):
    """Template pages: several shared lines, so that most texts share their smallest hash."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    shared = [f"shared line {word()}" for _ in range(30)]
    few = "a line of exactly twenty pages"
    rows = []
    for k in range(40):
        own = " ".join(word() for _ in range(60))
        lines = [*shared, own] + [few] * (k < 20)
        rows.append((k, "\n".join(lines), "host"))
    rows += [(100 + k, rows[0][1], "host") for k in range(30)]
    limits = line_quality.LineLimits(min_docs=20, max_repeat_percent=100)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts_of = defaultdict(set)
    for _, t, h in rows:
        for x in t.split("\n"):
            texts_of[h, normal(x)].add(t)
    above = {x for (_, x), s in texts_of.items() if len(s) > 20}
    assert above == {normal(x) for x in shared}
    got = by_id(line_quality.line_quality(df, limits=limits))
    for k, t, _ in rows:
        left = [x for x in t.split("\n") if normal(x) not in above]
        assert got[k].words_left == len(SPACE.findall("\n".join(left))), k
        assert len(got[k].removed) == 30


def brute_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = SPACE.findall(low)
    if not words:
        return 0
    pieces = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(prints):
    """Smallest id reachable over links of at most two bits, by all pairs."""
    root = dict.fromkeys(prints)
    for k in sorted(prints):
        if root[k] is None:
            todo = [k]
            while todo:
                x = todo.pop()
                if root[x] is None:
                    root[x] = k
                    todo += [y for y in prints if root[y] is None and (prints[x] ^ prints[y]).bit_count() <= 2]
    return root


def test_simhash(spark, sf):
    got = by_id(queries.op9_simhash_near_dedup(spark, sf[0]))
    prints = {k: brute_simhash(t) for k, t in enumerate(sf[1])}
    roots = reach(prints)
    for k, p in prints.items():
        assert (got[k].fingerprint, got[k].component_id) == (f"{p:016x}", roots[k])


@pytest.mark.parametrize("long_list", [4, 512])
def test_links_of_chains_and_balls(spark, monkeypatch, long_list):
    """Lists that are split and lists that are tallied whole."""
    from lakejobs.llm.components import components

    monkeypatch.setattr(simhash, "LONG_LIST", long_list)

    rng = random.Random(2)
    prints = set()
    for _ in range(25):
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            prints.add(p)
            for _ in range(rng.choice([1, 2, 2, 3])):
                p ^= 1 << rng.randrange(64)
    ball = rng.getrandbits(64)
    prints |= {ball ^ (rng.getrandbits(16) << 20) for _ in range(500)}
    want = reach({p: p for p in prints})
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    groups = defaultdict(set)
    for p in prints:
        groups[roots.get(signed(p), signed(p))].add(p)
    expected = defaultdict(set)
    for p, r in want.items():
        expected[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_long_lists_equal_short_ones():
    """A list that shares six bytes: looked up and tallied alike."""
    rng = random.Random(6)
    for bits in (3, 6, 9, 16):
        base = rng.getrandbits(63)
        some = {base ^ (rng.getrandbits(bits) << 24) for _ in range(400)}
        values = np.array(sorted(signed(x) for x in some), np.int64)
        assert (simhash.looked_up(values) == simhash.tallied(values)).all()


def test_keep_first(spark, sf):
    docs = spark.read.parquet(f"{sf[0]}/documents.parquet")
    prints = {k: brute_simhash(t) for k, t in enumerate(sf[1])}
    roots = reach(prints)
    doubled = docs.union(docs)
    kept = simhash.keep_first(doubled)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def edit_places(p, c, budget):
    """Least edits of p against any substring of c that ends at each place, plainly."""
    row = [0] * (len(c) + 1)
    for i, ch in enumerate(p, 1):
        new = [i]
        for j, x in enumerate(c, 1):
            new.append(min(row[j - 1] + (ch != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row) if min(row) <= budget else None


def low(text):
    return "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else " " if "\t" <= c <= "\r" else c for c in text or ""
    )


def test_decontamination_finds_all_within_budget():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 40)))) for k in range(25)]
    items += [(90, "short"), (91, ""), (92, "   ")]
    index = decontam.Index(items)
    found = missed = 0
    for trial in range(150):
        k, t = rng.choice(items[:25])
        chars = list(t)
        for _ in range(rng.randint(0, max(1, len(t) // 8))):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, "z"), lambda: chars.__setitem__(at, "q")])()
        text = " ".join(word() for _ in range(rng.randint(0, 30))) + " " + "".join(chars)
        text += " " + " ".join(word() for _ in range(rng.randint(0, 30)))
        got = {i: e for i, _, _, e in decontam.search_text(index, text)}
        budget = int(decontam.plan_of(decontam.code_points(t), 8, 0.1).edits)
        want = edit_places(low(t), low(text), budget)
        assert got.get(k) == want, (trial, t, text)
        found += want is not None
        missed += want is None
    assert found > 40 and missed > 10


def test_decontamination(spark, sf):
    got = queries.op4_benchmark_decontamination(spark, sf[0]).collect()
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{sf[0]}/benchmark.parquet").collect()}
    hits = {(r.doc_id, r.item_id): r for r in got}
    for k, t in enumerate(sf[1]):
        for item, b in bench.items():
            if not (b or "").strip():
                want = None
            elif len(b.strip()) < 8:
                want = 0 if low(b.strip()) in low(t) else None
            else:
                budget = decontam.plan_of(decontam.code_points(b), 8, 0.1).edits
                want = edit_places(low(b), low(t), budget)
            r = hits.get((k, item))
            assert (r.edits if r else None) == want, (k, item)
            if r and r.edits == 0:
                assert low(t)[r.start : r.end] == low(b.strip())
    docs = spark.read.parquet(f"{sf[0]}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf[0]}/benchmark.parquet")
    kept = decontam.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(sf[1]))) - {k for k, _ in hits}
    blocks = decontam.matches(docs, benchmark, block_chars=20).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (2 if n % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.findall("[0-9]", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_pii(spark, sf):
    got = by_id(queries.op10_pii(spark, sf[0]))
    for k, t in enumerate(sf[1]):
        base = base_pii(t or "")
        r = got[k]
        counts = Counter(x[0] for x in base)
        assert [r[f"n_{x}"] for x in pii.KINDS] == [counts[x] for x in pii.KINDS]
        listed = [f"{a}:{b}:{c}" for a, b, c in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans)


def test_base_patterns_on_random_signs():
    rng = random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choices("ab1234567890@@..+- ()_%é", k=rng.randint(0, 60)))
        assert pii.plain(t) == base_pii(t), t


@pytest.mark.parametrize(
    "text, want",
    [
        ("write joe (at) mail [dot] example.com now", [("email", "joe (at) mail [dot] example.com")]),
        ("joe at mail dot example dot com", [("email", "joe at mail dot example dot com")]),
        ("é plаin@exаmple.org", [("email", "plаin@exаmple.org")]),
        ("call plus one six six four five five five one two three four",
         [("phone", "plus one six six four five five five one two three four")]),
        ("a​b@c​.de", [("email", "a​b@c​.de")]),
        ("４１１１ １１１１ １１１１ １１１１", [("card", "４１１１ １１１１ １１１１ １１１１")]),
        ("look at the dot on the map, one two three", []),
        ("he is at home.But no", []),
        ("look at example.com today", []),
        ("ouan.84 at mail4.example.com for", [("email", "ouan.84 at mail4.example.com")]),
        ("joe[at]mail[dot]example[dot]org", [("email", "joe[at]mail[dot]example[dot]org")]),
    ],
)
def test_disguises(text, want):
    assert [(k, text[a:b]) for k, a, b, _ in pii.find(text)] == want


@pytest.mark.parametrize(
    "text, kind",
    [
        ("+49 170 five 5 six 7 eight 9 zero", "phone"),
        ("4111 1111 1111 one one 1 one", "card"),
        ("4111 1111 1111 111 one", "card"),
        ("192 dot 168 dot 0 dot 1", "ip"),
        ("plus 49 170 5551234", "phone"),
        ("joe@mail dot com", "email"),
        *((f"anna at example dot {x}", "email") for x in "pl ru jp cn in au br se museum".split()),
    ],
)
def test_disguises_without_others_in_the_text(text, kind):
    for t in (text, f"so {text}, then", f"{text} and x@y.zz with joe (at) mail (dot) org"):
        at = t.index(text)
        assert (kind, at, at + len(text), False) in pii.find(t), t


def test_a_whole_number_keeps_its_end():
    t = "４１１１ １１１１ １１１１ １１１１ one day"
    assert [(k, t[a:b]) for k, a, b, _ in pii.find(t)] == [("card", t[:19])]
    for t in ("look at the dot on it", "in 1999 one of two, at 25 at home.But no", "at each dot in it"):
        assert pii.find(t) == [], t


def test_masking(spark):
    df = spark.createDataFrame(
        [(1, "mail a@b.cd now", 15), (2, None, None), (3, "clean", 5)],
        "doc_id long, text string, n_chars long",
    )
    assert sorted(map(tuple, pii.redact(df).collect()), key=str) == sorted(
        [(1, "mail <EMAIL> now", 16), (2, None, None), (3, "clean", 5)], key=str
    )


def test_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf[0]}/documents.parquet").limit(0)
    benchmark = spark.read.parquet(f"{sf[0]}/benchmark.parquet")
    assert line_quality.apply_line_quality(docs).count() == 0
    assert simhash.keep_first(docs).count() == 0
    assert decontam.decontaminate(docs, benchmark).count() == 0
    assert decontam.matches(docs, benchmark.limit(0)).count() == 0
    assert pii.redact(docs).count() == 0
    assert queries.piece_rows(docs).count() == 0
    assert licenses.find_notices(docs).count() == 0
    assert html_text.extract_pages(spark.read.parquet(f"{sf[0]}/pages.parquet").limit(0)).count() == 0
    assert decontam.decontaminate(
        spark.read.parquet(f"{sf[0]}/documents.parquet"), benchmark.limit(0)
    ).count() == len(sf[1])


def test_pipeline(spark, sf):
    """The whole pipeline against the plain versions of its stages."""
    import corpus_pipeline

    limits = line_quality.LineLimits()
    rows = [(k, t, "" if k % 11 == 5 else f"src{k % 3}") for k, t in enumerate(sf[1])]
    above = host_lines([(h, t) for _, t, h in rows], limits)
    left = {}
    for k, t, h in rows:
        failed = quality(t)[-1]
        words = len(SPACE.findall(t or ""))
        kept = [x for x in (t or "").split("\n") if (h, normal(x)) not in above]
        if not failed and 2 * len(SPACE.findall("\n".join(kept))) >= words:
            left[k] = "\n".join(kept)
    roots = reach({k: brute_simhash(t) for k, t in left.items()})
    left = {k: t for k, t in left.items() if roots[k] == k}
    bench = [r.text for r in spark.read.parquet(f"{sf[0]}/benchmark.parquet").collect()]
    for b in bench:
        if b and b.strip():
            budget = decontam.plan_of(decontam.code_points(b), 8, 0.1).edits if len(b) >= 8 else 0
            left = {
                k: t for k, t in left.items()
                if (edit_places(low(b), low(t), budget) is None if len(b) >= 8 else low(b) not in low(t))
            }
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.MODEL))
    want = {}
    for k, t in left.items():
        masked = pii.mask(t, [(a, b, kind) for kind, a, b, _ in pii.find(t)])
        want[k] = len(sp.encode(masked, add_bos=True, add_eos=True))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf[0]).collect()}
    assert got == want and len(got) > 3
