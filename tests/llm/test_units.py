"""Parts that need no Spark, against plain versions."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from topicloom.llm import boosted_trees, decontaminate, html_text, mixing, quality_rules, warc
from topicloom.llm.ngram_join import divide_skip, needed, search, shingle_sets
from topicloom.llm.substring_dedup import merge
from topicloom.llm.texts import LETTERS_DIGITS, LOWER, NOT_SPACE, Rolling, Words, pieces

TEXTS = [None, "", " \n\t", "one", "Ünï x y  z\n", "a b c d e f", "x" * 5_000, "a\x0bb\x0cc\rd", "é" * 40 + " ß", " wide"]


def one_piece(texts):
    return next(iter(pieces(pa.array(texts, pa.string()), 1 << 30)))


def test_words_equal_a_regular_expression():
    for limit in (1, 20, 1 << 20):
        rows = []
        for piece in pieces(pa.array(TEXTS, pa.string()), limit):
            words = Words(piece.data, piece.offsets, NOT_SPACE)
            spelled = [piece.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
            rows += [spelled[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
        assert rows == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


def test_letters_and_digits_equal_a_regular_expression():
    texts = ["Don't STOP-me_now 42x", "Ä-b\x7fc", None, "--"]
    piece = one_piece(texts)
    data = LOWER[piece.data]
    words = Words(data, piece.offsets, LETTERS_DIGITS)
    spelled = [data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    assert spelled == [w for t in lower for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]


def test_rolling_hash_depends_on_bytes_only():
    data = np.frombuffer(b"abcabcabd" * 3, np.uint8)
    h = Rolling(data)
    at = np.arange(len(data) - 2)
    codes = h.hash(at, at + 3)
    strings = [data[i : i + 3].tobytes() for i in at]
    assert len(set(zip(codes.tolist(), strings, strict=True))) == len(set(strings)) == len(set(codes.tolist()))


@pytest.mark.parametrize("seed", range(40))
def test_divide_skip_equals_counting(seed):
    draw = random.Random(seed)
    lists = [sorted(draw.sample(range(30), draw.randint(0, 30 if draw.random() < 0.3 else 4))) for _ in range(draw.randint(0, 20))]
    counts = Counter(i for x in lists for i in x)
    for t in range(1, 15):
        assert sorted(divide_skip(lists, t, mu=draw.choice([0.001, 0.1, 1]))) == sorted((i, n) for i, n in counts.items() if n >= t)


def test_search_equals_set_arithmetic():
    draw = np.random.default_rng(1)
    query = np.unique(draw.integers(0, 60, 30).astype(np.uint64))
    partners = [np.unique(np.append(draw.permutation(query)[: draw.integers(0, 30)], draw.integers(0, 80, draw.integers(1, 6))).astype(np.uint64)) for _ in range(80)]
    plain = []
    for i, p in enumerate(partners):
        both = len(set(p.tolist()) & set(query.tolist()))
        if 100 * both >= 75 * (len(p) + len(query) - both):
            plain.append(i)
    assert search(query, partners) == plain and plain
    assert needed(4, 4) == 4 and needed(8, 8) == 7


def test_shingle_sets():
    sets = shingle_sets(one_piece(["a b c d e f", "A B C D E F", "a b", "", None, "a b c d e a b c d e"]))
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 5 + 1 - 1]
    assert (sets[0] == sets[1]).all() and not set(sets[2].tolist()) & set(sets[0].tolist())


def plain_hits(text, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    doc, hit, found = words(text), set(), set()
    for i, item in enumerate(items):
        w = words(item)
        size = min(window, len(w))
        for a in range(len(w) - size + 1) if size else ():
            for b in range(len(doc) - size + 1):
                if doc[b : b + size] == w[a : a + size]:
                    hit |= set(range(b, b + size))
                    found.add(i)
    return len(doc), len(hit), found


@pytest.mark.parametrize("seed", range(6))
def test_wu_manber_equals_comparing_everywhere(seed):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "Cc", "d1", "é"]
    items = [None, "", "-", *(" ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 3, 9, 10, 11, 14]))) for _ in range(5)), "a"][: draw.choice([3, 8, 9])]
    texts = [None, "", *(" ".join(draw.choices(vocabulary, k=draw.randint(0, 500))) for _ in range(8))]
    texts += [f"x {' '.join(draw.choices(vocabulary, k=4))} {(i or '').upper().replace(' ', '. ')} y" for i in items]
    tables = decontaminate.build_tables(items)
    for piece in pieces(pa.array(texts, pa.string()), 900):
        words, hit, found = decontaminate._occurrences(tables, piece)
        for i in range(len(piece)):
            a, b = words.offsets[i], words.offsets[i + 1]
            assert (b - a, hit[a:b].sum(), found.get(i, set())) == plain_hits(texts[piece.rows[i]], items)


def plain_counts(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated)


def test_verdict_bands():
    draw = random.Random(3)
    prose = " ".join("".join(draw.choices("etaoinshr", k=draw.randint(2, 9))) for _ in range(3_000))
    limits = (quality_rules.BANDS, quality_rules.CHUNK, quality_rules.CHUNK_BAND)
    assert quality_rules.verdict(prose.encode(), *limits)[2]
    assert not quality_rules.verdict(b"spam and eggs " * 500, *limits)[2]
    noise = "".join(chr(draw.randrange(33, 127)) for _ in range(20_000)).encode()
    assert not quality_rules.verdict(noise, *limits)[2]
    half = prose.encode()[:8_192] + noise[:12_288]
    assert quality_rules.verdict(half, *limits)[1] > 0.5 and not quality_rules.verdict(half, *limits)[2]
    assert quality_rules.verdict(b"", *limits) == (0.0, 0.0, True)


def long_prose(size):
    draw = random.Random(8)
    vocabulary = ["".join(draw.choices("etaoinshr", k=draw.randint(2, 9))) for _ in range(2_000)]
    return " ".join(draw.choices(vocabulary, k=size // 3)).encode()[:size]


@pytest.mark.parametrize("kind", ["noise", "repeats"])
@pytest.mark.parametrize("percent", [10, 20, 30, 45])
def test_verdict_finds_one_odd_stretch(kind, percent):
    size = 39_799
    limits = (quality_rules.BANDS, quality_rules.CHUNK, quality_rules.CHUNK_BAND)
    prose = long_prose(size)
    assert len(prose) == size and quality_rules.verdict(prose, *limits)[1:] == (0.0, True)
    length = size * percent // 100
    stretch = base64.b85encode(random.Random(size).randbytes(length))[:length] if kind == "noise" else (b"spam and eggs " * length)[:length]
    for at in range(0, size - length + 1, 700):
        assert not quality_rules.verdict(prose[:at] + stretch + prose[at + length :], *limits)[2]


def test_verdict_checks_chunks_of_texts_from_one_chunk_on():
    limits = (quality_rules.BANDS, quality_rules.CHUNK, quality_rules.CHUNK_BAND)
    prose = long_prose(4_091)
    for stretch in (base64.b85encode(random.Random(1).randbytes(3_280)), (b"spam and eggs " * 300)[:4_100]):
        whole, odd, inside = quality_rules.verdict(prose + stretch, *limits)
        assert 0 < odd < 1 and not inside and len(prose + stretch) < 2 * quality_rules.CHUNK


def test_targets():
    assert mixing.target_sizes([], [], 3) == []
    assert mixing.target_sizes([100, 100, 100], [1, 2, 3], 3) == [50, 100, 150]
    assert mixing.target_sizes([10, 100, 100], [1, 2, 3], 3) == [30, 72, 108]
    assert mixing.target_sizes([0, 10], [1, 2], 3) == [0, 10]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1_000])
def test_permutation(size):
    n = np.full(size, size)
    for seed in (1, 2):
        found = mixing.permuted(np.arange(size), n, np.full(size, seed, np.uint64))
        assert sorted(found.tolist()) == list(range(size))
    if size >= 64:
        assert found.tolist() != list(range(size))


def test_trees_learn_a_rule():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4_000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    forest = boosted_trees.train(x[:3_000], y[:3_000])
    assert ((boosted_trees.predict(forest, x[3_000:]) > 0.5) == y[3_000:]).mean() > 0.97
    for one in (np.zeros(0), np.ones(5)):
        constant = boosted_trees.train(np.zeros((len(one), 6)), one)
        assert np.unique(boosted_trees.predict(constant, x)).size == 1


def test_archive_round_trip_and_damage():
    draw = random.Random(7)
    records = [warc.record(i, f"http://a/{i}", f"<p>{draw.random()} common words of all pages</p>".encode() * 20, "d", None) for i in range(50)]
    data = warc.pack(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.unpack(data)) == records
    assert list(warc.unpack(warc.pack([]))) == [] and list(warc.unpack(warc.pack(records[:1]))) == records[:1]
    with pytest.raises(ValueError):
        list(warc.unpack(data[:-3]))
    with pytest.raises(ValueError):
        list(warc.unpack(b"12345678"))


def test_record_fields():
    body = "é\r\n\r\n".encode()
    digest = hashlib.sha256(body).hexdigest()
    first, again = warc.parse(warc.record(1, "http://x/\r\ny", body, digest, None)), warc.parse(warc.record(2, None, body, digest, 1))
    assert (first["page_id"], first["payload"], first["target"], first["record_type"]) == (1, body, "http://x/ y", "response")
    assert (again["refers_to"], again["payload_bytes"], again["payload_digest"], again["payload"]) == (1, len(body), digest, None)
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", body, "0" * 64, None))


PARAGRAPH = "This is a sentence of the article, which has commas, and goes on for a good while. "


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <br> c", "a b c"),
        (f"<nav><a href=x>Menu</a></nav><article><h1>T&eacute;</h1><p>{PARAGRAPH}<p>x &lt;y&gt;</article><footer>F</footer>", f"Té {PARAGRAPH.strip()} x <y>"),
        (f"<div class='sidebar'><p>{PARAGRAPH * 9}</p></div><div id=content><p>{PARAGRAPH}</p><p>Short.</p></div>", f"{PARAGRAPH.strip()} Short."),
        (f"<div><p>{PARAGRAPH}</p><div class=comments><p>{PARAGRAPH * 5}</p></div></div>", PARAGRAPH.strip()),
        (f"<main><p>{PARAGRAPH}</p><form><p>{PARAGRAPH}</p></form><script>var a='</p>';</script><style>p</style></main>", PARAGRAPH.strip()),
        (f"<body><div class='cookie-notice'>{PARAGRAPH}</div><div class='post'><div><p>{PARAGRAPH}</p></div></div>", PARAGRAPH.strip()),
        ("<!-- <p>no</p> --><p>1 < 2</p>", "1 < 2"),
        (f"<div><ul><li><a href=1>{PARAGRAPH}</a><li><a href=2>{PARAGRAPH}</a></ul></div><div><p>{PARAGRAPH * 3}</p></div>", (PARAGRAPH * 3).strip()),
    ],
)
def test_html_text(html, text):
    assert html_text.extract(html) == text


A, B, C = (f"{x} {PARAGRAPH * 3}".strip() for x in ("First", "Second", "Third"))
LINKS = f"<div><a href=1>{PARAGRAPH}</a> <a href=2>{PARAGRAPH}</a></div>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<main><h1>Title</h1><article><p>{A}</p></article><p>more</p></main>", f"Title {A} more"),
        (f"<body><article><p>{A}</p></article><article><p>{B}</p></article>{LINKS}</body>", f"{A} {B}"),
        (f"<main><section><article><p>{A}</p></article></section><section><article><p>{B}</p></article></section>{LINKS}</main>", f"{A} {B}"),
        (f"<body><div><section><article><p>{A}</p></article></section><section><p>{B}</p></section></div>{LINKS}<div><p>Short.</p></div></body>", f"{A} {B}"),
        (f"<main>Bare text. <div><article><p>{A}</p><p>{A}</p></article><h2>Then</h2></div><div><p>{B}</p></div>{LINKS} and the end</main>", f"Bare text. {A} {A} Then {B} and the end"),
        (f"<body><article><h1>T</h1><p>{A}</p><div><article><p>{B}</p><p>{C}</p></article></div></article></body>", f"T {A} {B} {C}"),
        (f"<body><main><p>{A}</p></main><div><p>{B}</p><p>{C}</p></div>{LINKS}</body>", f"{A} {B} {C}"),
        (f"<main><article><p>{A}</p></article><div><div><h4>No</h4>{LINKS}</div><section>{LINKS}<article><p>{B}</p></article></section></div></main>", f"{A} {B}"),
        (f"<main><article><p>{A}</p></article><aside><p>{B}</p></aside><div class='related'><p>{B}</p></div></main>", A),
    ],
)
def test_html_text_beside_an_article(html, text):
    assert html_text.extract(html) == text


def test_html_never_fails():
    draw = random.Random(11)
    parts = ["<p>", "</p>", "<div class=\"ad\">", "</div>", "<a href='x'>", "</a>", "<li>", "<table><tr><td>", "<", ">", "&amp;", "&#x;", "<script>", "</script>", "text, ", "<!--", "-->", "<b", "'", '"', "<br/>", "</body>", "<body>", "<h1>"]
    for _ in range(300):
        html_text.extract("".join(draw.choices(parts, k=40)))


def test_merge():
    assert merge([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
    assert math.isclose(sum(b - a for a, b in merge([])), 0)
