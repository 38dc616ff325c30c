"""Very long and very deep inputs through the registered queries, pages made from known
articles, and planted disguises."""

from __future__ import annotations

import html as entities
import random
import time

import pytest

from lakejobs.llm import html_text, licenses, pii, queries, simhash

M = 1_000_000
LONG = {
    "blanks": " " * M,
    "line ends": "\n" * M,
    "one word": "x" * M,
    "words and lines": "ab c\n" * M,
    "backslashes": "\\" * M + "x",
    "number word and blanks": "one" + " " * M,
    "digit and blanks": "1" + " " * M,
    "bracket and blanks": "(" + " " * M + "at)",
    "notices": "mit licence " * 20_000,
    "half notices": "license mit general " * 20_000,
    "at and dot": "a at b dot " * 50_000,
    "signs": "a@" * 300_000,
    "cyrillic": "о" * M,
    "stops": "1." * 300_000,
    "control": "\\### Assistant:" * 50_000,
}
DEEP = {
    "headers": "<header>" * 50_000 + "text",
    "sections": "<section>x" * 50_000,
    "paragraphs": "<p>x" * 100_000,
    "lists": "<ul><li>" * 50_000 + "text",
    "tables": "<table><tr><td>" * 20_000 + "text",
    "open quotes": '<a href="x ' * 50_000,
    "less-than signs": "<" * 300_000,
    "attributes": "<div " + "a " * 300_000 + ">text",
    "one long word": "<p>" + "x" * M,
    "bold": "<b>x" * 50_000,
}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("long"))
    docs = [(k, t, "en", "s", len(t)) for k, t in enumerate(LONG.values())]
    pages = [(k, f"u{k}", t) for k, t in enumerate(DEEP.values())]
    turns = [(k, 0, "assistant", t) for k, t in enumerate(LONG.values())]
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
        ("pages", pages, "page_id long, url string, html string"),
        ("conversations", turns, "conv_id long, turn long, role string, text string"),
        ("benchmark", [(1, "an item that nothing here has, of some length")], "item_id long, text string"),
        ("labels", [(k, 1, k % 2) for k in range(len(LONG))], "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(rows, schema).repartition(8).write.parquet(f"{top}/{name}.parquet")
    return top


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q != "op6_sentencepiece"])
def test_long_texts_take_a_bounded_time(spark, sf, name):
    start = time.time()
    got = queries.QUERIES[name](spark, sf)
    rows = got.count()
    if "doc_id" in got.columns and not name.startswith(("op3", "op4")):
        assert rows == len(LONG)
    assert time.time() - start < 240


def test_long_turns_read_back(spark, sf):
    import hashlib

    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, sf).collect()}
    for k, t in enumerate(LONG.values()):
        assert got[k].loss_chars == len(t), list(LONG)[k]
        assert got[k].loss_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("name", LONG)
def test_each_text_alone(name):
    """Seconds at most for a text of a million characters and more."""
    for f in (pii.find, licenses.scan, simhash.simhash):
        start = time.time()
        f(LONG[name])
        assert time.time() - start < 30, f


@pytest.mark.parametrize("name", DEEP)
def test_each_page_alone(name):
    start = time.time()
    html_text.article_text(DEEP[name])
    assert time.time() - start < 30


# --- pages made from known articles ------------------------------------------

NAMES = (
    "comment share-price notice-text story lead widget-free header footer related-work "
    "menu-of-the-day cookie social body banner"
).split()


def sentence(rng, low=4, high=30):
    return " ".join("".join(rng.choices("abcdefghiäö", k=rng.randint(1, 9))) for _ in range(rng.randint(low, high))) + "."


def page(rng):
    """(html, article text): noise of any length around an article with paragraphs of any class."""
    title = sentence(rng, 2, 6)
    blocks = [f"<h1>{title}</h1>"]
    text = [title]
    for _ in range(rng.randint(1, 12)):
        s = sentence(rng, 1, 60)
        shown = entities.escape(s) if rng.random() < 0.8 else s
        kind = rng.choice(["plain", "class", "id", "bold", "link", "list", "table"])
        text.append(s)
        if kind == "class":
            blocks.append(f'<p class="{rng.choice(NAMES)}">{shown}</p>')
        elif kind == "id":
            blocks.append(f"<p id={rng.choice(NAMES)}>{shown}")
        elif kind == "bold":
            first, _, rest = s.partition(" ")
            blocks.append(f"<p><b>{first}</b> {rest}</p>")
        elif kind == "link" and " " in s:
            first, _, rest = s.partition(" ")
            blocks.append(f'<p>{first} <a href="/menu">{rest}</a></p>')
        elif kind == "list":
            blocks.append(f"<ul><li>{shown}</li></ul>")
        elif kind == "table":
            blocks.append(f"<table><tr><td>{shown}</td></tr></table>")
        else:
            blocks.append(f"<p>{shown}</p>")
    article = "".join(blocks)
    if rng.random() < 0.5:
        cut = rng.randint(1, len(blocks))
        hidden = f'<div style="color:red; display : none">{sentence(rng)}</div>'
        article = "".join(blocks[:cut]) + hidden + "".join(blocks[cut:])

    def noise():
        long = " ".join(sentence(rng) for _ in range(rng.choice([1, 1, 3, 60])))
        return rng.choice([
            f"<nav><ul><li><a href=/a>{sentence(rng, 1, 3)}</a></li></ul></nav>",
            f'<div class="user-comments"><p>{long}</p></div>',
            f'<section id="comments"><div class="comment"><p class="comment-text">{long}</p></div></section>',
            f'<ol class="commentlist"><li>{long}</li></ol>',
            f"<aside><p>{long}</p></aside>",
            f'<div class="adBanner">{long}</div>',
            f'<div class="cookie-notice"><p>{long}</p></div>',
            f'<div role="complementary">{long}</div>',
            f"<footer><p>{long}</p></footer>",
            f"<form><label>{long}</label></form>",
            f'<div class="related-posts"><p>{long}</p></div>',
            f"<div hidden>{long}</div><!-- {long} --><script>var x='<p>{long}</p>'</script>",
        ])

    before = "".join(noise() for _ in range(rng.randint(0, 3)))
    after = "".join(noise() for _ in range(rng.randint(0, 4)))
    wrap = rng.choice(["<article>{}</article>", "<main>{}</main>", '<div class="content has-sidebar">{}</div>'])
    return f"<html><body>{before}{wrap.format(article)}{after}</body></html>", " ".join(text)


def test_pages_of_known_articles():
    rng = random.Random(12)
    wrong = []
    for k in range(400):
        made, want = page(rng)
        got = html_text.article_text(made)
        if got != " ".join(want.split()):
            wrong.append(k)
    assert not wrong, f"{len(wrong)} of 400: {wrong[:9]}"


@pytest.mark.parametrize("share", [1, 5, 50, 500])
def test_comments_of_any_length_go(share):
    """Whether a block is noise does not depend on its share of the page."""
    article = "<article><h1>Title</h1><p class='comment'>Some words of the article.</p></article>"
    comments = f"<div class='user-comments'><p>{'What readers say. ' * share}</p></div>"
    assert html_text.article_text(f"<body>{article}{comments}</body>") == "Title Some words of the article."


def test_headings_and_headers():
    site = "<header><p>Site name</p><nav><a href=/>Home</a></nav></header>"
    own = "<article><header><h1>Title</h1></header><p>Long text of it, with words.</p></article>"
    assert html_text.article_text(site + own) == "Title Long text of it, with words."
    lone = "<header><h1>Title</h1></header><div><p>Long text of it, with words and more words.</p></div>"
    assert html_text.article_text(lone) == "Title Long text of it, with words and more words."
    only = "<div class='comments'><p>Nothing but this text is here.</p></div>"
    assert html_text.article_text(only) == "Nothing but this text is here."


# --- planted disguises -------------------------------------------------------

LOOKS = dict(zip("aceopxyi", "асеорхуі"))


def test_disguised_addresses_are_covered_whole():
    rng = random.Random(3)
    found = total = 0
    for _ in range(600):
        name = "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
        host = "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
        top = rng.choice(["com", "org", "de", "pl", "museum"])
        address = f"{name}@{host}.{top}"
        kind = rng.choice(["look", "bracket", "words", "invisible", "stop"])
        if kind == "look":
            places = [k for k, c in enumerate(address) if c in LOOKS]
            for k in rng.sample(places, min(len(places), rng.randint(1, 3))):
                address = address[:k] + LOOKS[address[k]] + address[k + 1 :]
        elif kind == "bracket":
            address = f"{name} (at) {host} [dot] {top}"
        elif kind == "words":
            address = f"{name} at {host} dot {top}"
        elif kind == "invisible":
            k = rng.randint(1, len(address) - 1)
            address = address[:k] + "​" + address[k:]
        else:
            address = f"{name}@{host}․{top}"
        text = f"Please write to {address}, or call."
        start = text.index(address)
        total += 1
        found += any(
            k == "email" and a <= start and start + len(address) <= b for k, a, b, _ in pii.find(text)
        )
    assert found >= 0.9 * total, f"{found} of {total}"


def test_homoglyphs_leave_no_letter_behind():
    for plain in ("john@example.com", "mary.smith@mail.example.org"):
        for k, c in enumerate(plain):
            if c in LOOKS:
                text = plain[:k] + LOOKS[c] + plain[k + 1 :]
                spans = [(a, b, kind) for kind, a, b, _ in pii.find(text)]
                assert pii.mask(text, spans) == "<EMAIL>", text


def test_base_spans_stay():
    for text in ("jоhn@example.com", "call +49 170 5551234 one two", "a@b.cd dot ef and x@y.zz"):
        base = [(*x, True) for x in pii.plain(text)]
        assert [x for x in pii.find(text) if x[3]] == base


def test_clean_prose_has_no_spans():
    rng = random.Random(9)
    said = (
        "We looked at the dot on the map. They met at noon. One of two or three times it rained! "
        "At home there were four, five or six of them. The line ends at a dot. Plus ten percent, "
        "they said. Nobody was at work; seven people were at sea. See page 12 at the end. "
        "Version 1.2.3 came at ten. He was number one at school. Two at a time, please. "
        "Look at it. The polka dot dress cost 99 at most."
    ).replace("!", ".").split(". ")
    for _ in range(500):
        text = ". ".join(rng.choices(said, k=12))
        assert pii.find(text) == [], text
    for text in ("looked at the dot com", "met at noon dot it", "at one dot the line ends"):
        assert pii.find(text) == []


def test_short_notices_keep_their_word():
    for text in ("it license", "hit license", "sit license", "licensed under us by"):
        assert licenses.scan(text)[2] == [], text
    assert [f[2] for f in licenses.scan("the mit licence")[2]] == ["mit"]


def test_fuzzy_notices_against_all_windows():
    """Every stretch of words within the budget that no better one overlaps is reported."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(4)
    vocabulary = "mit license licence mitt lisense the of gnu apache apach general public publik".split()
    notices = {p: (label, max(1, len(p) // 10)) for p, label in licenses.NOTICES.items()}
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randint(1, 25))
        got = licenses.scan(" ".join(words))[2]
        for first, last, label, edits, _ in got:
            said = " ".join(words[first : last + 1])
            assert any(x == label and distance(p, said) <= edits <= e for p, (x, e) in notices.items())
        for phrase, (label, budget) in notices.items():
            fixed = {w for w in phrase.split() if len(w) <= 3} if len(phrase) <= 24 else set()
            for i in range(len(words)):
                for j in range(i, min(len(words), i + 7)):
                    said = words[i : j + 1]
                    if fixed <= set(said) and distance(phrase, " ".join(said)) <= budget:
                        assert any(x == label and a <= j and i <= b for a, b, x, *_ in got), (words, said)


def test_a_turn_opened_once_is_the_turn_read():
    import public_tokenizers

    from lakejobs.llm import chat

    coder = chat.coder_of(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    rng = random.Random(1)
    parts = ["ab ", "\\", "### User:", "</turn>", "\n", "é😀"]
    texts = ["", "a" * 50, " \n", "\\\\"] + ["".join(rng.choices(parts, k=20)) for _ in range(100)]
    for role in ("user", "assistant", "odd\\n role", "", "### User:"):
        for text in texts:
            ((ids, mask),) = coder.assemble([role], [text])
            got = coder.open_turn(ids, mask)
            assert got[:2] == coder.read_turn(ids) == (role, text)
            assert got[2] == (coder.read_loss(ids, mask) if mask.any() else None)
            assert got[3] == len(coder.write_turn(ids))
