"""Parts that need no Spark: max-flow, HTML blocks, edit search, chunk joins, fingerprints, tries, automata."""
import itertools
import random
import time

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tripwire.llm import bpe, decontam, html, simhash, substring, suffix, urls


def test_min_cut_is_the_least_labelling():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(1, 8)
        costs = [(rng.choice([0, rng.random() * 4]), rng.choice([0, rng.random() * 4])) for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def total(keep):
            return sum(c[1] if k else c[0] for c, k in zip(costs, keep)) + sum(w for a, b, w in edges if keep[a] != keep[b])

        best = min(total(k) for k in itertools.product([True, False], repeat=n))
        assert abs(total(html.min_cut(costs, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
<header class="site-header"><a href="/">Home</a> Site of things</header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept all of them now please.</div>
<main><article><h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b>\n text, long enough.<p>Second &eacute; one<br>goes on.</p>
<ul><li>Item one</li><li>Item two is here.</li></ul><div class="ad">Buy now! Really good offers here.</div><p>x</p></article>
<aside class="sidebar"><p>Related stories that are long enough to read.</p></aside>
<form><label>Name</label><input><button>Send</button></form>
<section id="comments"><p>Reader comment which is rather long and full of sentences.</p></section></main>
<!-- <p>hidden</p> --><footer>&copy; 2024 Some company. All rights reserved.</footer></body></html>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE) == ("Title & more\nFirst paragraph with bold text, long enough.\nSecond é one goes on.\nItem one\n"
                                    "Item two is here.\nx")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html>", ""), ("<article><p>Only a short end", "Only a short end"),
    ("<article><p>a &lt;b&gt; c &#233; &nbsp;x</p></article>", "a <b> c é \xa0x"),
    ("<p>Plain text that makes a paragraph, and then some more of it.</p>" * 2, "\n".join(["Plain text that makes a paragraph, and then some more of it."] * 2)),
    ("<article><p>one <a href='x>y'>link</a> two words here.</p></div></article>", "one link two words here."),
    ("<article><p>kept here as a text.</p><script>if (a<b) x('</p>')</script><p>and this too.</p></article>", "kept here as a text.\nand this too."),
    ("<article><p style='display:none'>not seen by anyone</p><p>Seen by all of the readers.</p></article>", "Seen by all of the readers."),
    ("<article><p>unclosed <b>bold<p>next paragraph here.</article><footer>end", "unclosed bold\nnext paragraph here."),
])
def test_main_text_cases(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("head, body", [
    ('<div><svg class="icon"/></div>', ""), ("<math display='block' />", ""), ("<SVG/>", '<svg><text>drawn</text></svg>'),
    ('<svg class="a"/><svg class="b"/>', '<p>Next one <svg viewBox="0 0 1 1"/>here.</p><svg><path d="M0"/><title>drawn</title></svg>'),
    ("<svg class=a/><text>drawn</text></svg>", ""),  # the slash is the value's, so the element is open
])
def test_self_closing_svg_drops_no_text(head, body):
    text = html.main_text(f"{head}<article><p>First text of the article here.</p>{body}<p>Last text of the article here.</p></article>")
    middle = ["Next one here."] if "Next one" in body else []
    assert text.split("\n") == ["First text of the article here.", *middle, "Last text of the article here."]


ARTICLE = "First sentence of the article, which is long enough. " * 4
REMARK = "I read it all and do not agree with the author, for many reasons. " * 4


@pytest.mark.parametrize("name", ["post-comments", "main-menu", "content-sidebar", "article-footer", "post_share", "entry-related", "comment-body", "box comment-text"])
def test_a_bad_word_outweighs_a_good_one_in_a_name(name):
    assert html.main_text(f'<div class="post"><p>{ARTICLE}</p></div><div class="{name}"><p>{REMARK}</p></div>') == ARTICLE.strip()


@pytest.mark.parametrize("name", ["post tag-news", "content has-sidebar", "content-sidebar-wrap", "main-with-sidebar", "entry-header", "content-no-sidebar wide"])
def test_names_that_tell_nothing_keep_the_text(name):
    assert html.main_text(f'<div class="{name}"><p>{ARTICLE}</p></div>') == ARTICLE.strip()


@pytest.mark.parametrize("name", ["search-algorithms", "side-effects", "related-work", "legal-framework", "notice-periods", "comments-on-method", "share-prices",
                                  "tag-systems", "navigation-by-stars", "binary-search"])
def test_topics_named_like_parts_of_a_page_stay(name):
    first, last = "The article begins with this sentence, which is long.", "The article ends with this sentence, which is long."
    for part in (f'<section id="{name}"><h2>A topic</h2><p>{ARTICLE}</p></section>', f'<div class="{name}"><h2>A topic</h2><p>{ARTICLE}</p></div>'):
        assert html.main_text(f"<article><p>{first}</p>{part}<p>{last}</p></article>") == f"{first}\nA topic\n{ARTICLE.strip()}\n{last}"


@pytest.mark.parametrize("name", ["related-posts", "search-box", "side-bar", "share-buttons", "nav-links", "legal-links", "comments-area", "acme-sidebar", "site_footer", "tag-list"])
def test_parts_of_a_page_inside_an_article_go(name):
    assert html.main_text(f'<article><p>{ARTICLE}</p><div class="{name}"><p>{REMARK}</p></div></article>') == ARTICLE.strip()


def test_linked_title_and_references_piece_by_piece():
    page = f'<div class="content"><h1><a href="/x">A title that is one link</a></h1><p>{ARTICLE}</p></div>'
    assert html.main_text(page) == f"A title that is one link\n{ARTICLE.strip()}"
    assert html.main_text("<article><p>A&<b>amp;</b> and &lt;b&gt; &amp;amp; <![CDATA[&amp; raw]]> here.</p></article>") == "A&amp; and <b> &amp; &amp; raw here."


def test_quotes_open_values_only():
    assert html.main_text(f"<article><p title=it's>{ARTICLE}</p><p class='x>y' title=\"a='b\">{ARTICLE}</p></article>") == "\n".join([ARTICLE.strip()] * 2)
    assert html.main_text(f"<article><script>var a = \"<b x='\";</script><p class='x'>{ARTICLE}</p></article>") == ARTICLE.strip()
    assert html.main_text(f'<article><p title="class=ad id=nav">{ARTICLE}</p></article>') == ARTICLE.strip()


@pytest.mark.parametrize("page", [
    lambda n: "<div>x " * n, lambda n: "<a x='" * n, lambda n: "<b>" * n + "</i>" * n, lambda n: "<ul>" + "<h1>" * n + "<li/>" * n, lambda n: "<svg " + "</svg " * n,
    lambda n: "<p><i>" * n, lambda n: "<a " + "=" * n + '"', lambda n: "<b><div>" + "<i>" * n + "</b>" * n, lambda n: "<div>x " * n + "</div>y " * n, lambda n: "<" * n,
])
def test_hostile_markup_takes_linear_time(page):
    took = []
    for n in (4000, 32000):
        start = time.process_time()
        html.main_text(page(n))
        took.append(time.process_time() - start)
    assert took[1] < 24 * took[0] + 0.5  # 8 times the size; with the square it would be 64 times


def test_very_long_page():
    assert html.main_text("<article>" + "<p>word after word.</p>" * 20000 + "</article>").count("\n") == 19999
    assert html.main_text("<div>" * 3000 + "<p>A text deep down in the page, and no more.</p>") == "A text deep down in the page, and no more."


def _edit(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p):
        new = [i + 1]
        for j, b in enumerate(t):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=12), st.binary(max_size=30))
def test_edit_search(p, t):
    p, t = bytes(x % 3 for x in p), bytes(x % 3 for x in t)
    assert decontam.edit_search(p, t)[0] == _edit(p, t)


def _items(n=30, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    return [(i, " ".join(word() for _ in range(rng.randint(12, 50)))) for i in range(n)], word, rng


def test_matcher_finds_edited_items():
    items, word, rng = _items()
    m = decontam.Matcher(items)
    texts, planted = [], set()
    for k in range(120):
        i, t = rng.choice(items)
        t = list(t)
        for _ in range(int(len(t) * decontam.RATE)):
            p = rng.randrange(len(t))
            kind = rng.randrange(3)
            if kind == 0:
                t.insert(p, rng.choice("abc "))
            elif kind == 1:
                del t[p]
            else:
                t[p] = rng.choice("abc ")
        around = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(2)]
        texts.append(around[0] + " " + "".join(t).upper() + "\n" + around[1])
        planted.add((k, i))
    texts += [" ".join(word() for _ in range(200)) for _ in range(60)]
    found = m.find(texts)
    assert len({(d, i) for d, i, *_ in found} & planted) >= 0.99 * len(planted)
    for d, i, dist, a, b in found:  # exact verification, against the plain table
        item, raw = decontam.normal(dict(items)[i]), decontam.normal(texts[d])
        assert dist == _edit(item, raw) <= int(len(item) * decontam.RATE)
        assert _edit(item, raw[a:b]) == dist
    assert all(d < 120 for d, *_ in found)


def test_matcher_recall_for_every_item():
    # a few items that agree less than all others: long ones of one repeated word
    items, word, rng = _items(300, 5)
    items = [(i, t[:40]) for i, t in items] + [(1000 + i, (word() + " ") * 60) for i in range(4)]
    texts, planted = [], set()
    for i, t in items:
        raw = decontam.normal(t)
        e = int(len(raw) * decontam.RATE)
        for _ in range(20 if i >= 1000 else 4):
            cuts = [len(raw) * x // (e + 1) for x in range(e + 2)]
            whole, out = rng.randrange(e + 1), []
            for j, (a, b) in enumerate(zip(cuts, cuts[1:])):  # an edit in each piece but one
                x, p, kind = raw[a:b], rng.randrange(b - a), rng.randrange(3)
                out.append(x if j == whole else x[:p] + (b"" if kind == 1 else b"%c" % rng.choice(b"abcxyz")) + x[p + (kind != 0):])
            planted.add((len(texts), i))
            texts.append(word() + " " + b"".join(out).decode() + " " + word())
    assert len(planted) == 1280 and planted <= {x[:2] for x in decontam.Matcher(items).find(texts)}


def test_matcher_bounds_its_arrays(monkeypatch):
    items, word, rng = _items(20, 3)
    texts = [" ".join([word(), items[rng.randrange(20)][1], word()]) for _ in range(300)] + ["", None]
    m = decontam.Matcher(items)
    want = m.find(texts)
    assert len({d for d, *_ in want}) == 300
    work, sizes, joined = 200_000, [], []
    walk, sample, windows = decontam.Matcher._walk, decontam.Matcher._sample, decontam.Matcher.windows
    monkeypatch.setattr(decontam, "WORK", work, raising=False)
    monkeypatch.setattr(decontam, "JOINED", 5000, raising=False)
    monkeypatch.setattr(decontam.Matcher, "_walk", lambda *a: sizes.append((out := walk(*a)).nbytes) or out)
    monkeypatch.setattr(decontam.Matcher, "_sample", staticmethod(lambda e, w, c: sizes.append(8 * c[w].size) or sample(e, w, c)))
    monkeypatch.setattr(decontam.Matcher, "windows", lambda self, buf: joined.append(len(buf)) or windows(self, buf))
    assert m.find(texts) == want
    assert max(sizes) <= work and max(joined) < 6000 and len(joined) > 10


def test_matcher_small_cases():
    assert decontam.Matcher([]).find(["abc", None, ""]) == []
    m = decontam.Matcher([(1, "xyz"), (2, ""), (3, "xyz"), (4, "a longer item of several words, all of them here")])
    assert m.find([None, "", "wxyz", "A longer\titem of several words, all of them here"]) == [(2, 1, 0, 1, 4), (2, 3, 0, 1, 4), (3, 4, 0, 0, 48)]


@pytest.fixture(scope="module")
def tok():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_chunked_encoding_is_exact(tok, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_CHUNK", 64)  # many cuts at any character, so that joins are repaired
    enc, rng = bpe.ChunkEncoder(tok), random.Random(3)
    parts = ["the of and ", "don't we'll ", "   ", "\n\n", "é", "日本語の文章", "  x", "12345", "!!!", "\t", "ab" * 40, "aaaa", "<|endoftext|>", "🙂", "   "]
    texts = ["".join(rng.choice(parts[:12] + parts[13:]) for _ in range(rng.randint(0, 200))) for _ in range(150)]
    texts += ["".join(rng.choice(parts) for _ in range(100)) for _ in range(20)] + ["", "a", " " * 500, "x" * 3000, "日" * 2000]
    for t, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == enc.tok.encode(t, add_special_tokens=False).ids, t[:80]


def test_fast_encoder_has_the_same_ids(tok):
    slow, fast = bpe.tokenizer(tok)
    chars = [chr(c) for c in range(0, 0x110000, 37) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x3000)]
    for c in chars:
        t = f"a{c}b {c} {c}{c}1{c}!{c}  {c}x '{c}s"
        assert fast.encode(t, allowed_special="all") == slow.encode(t, add_special_tokens=False).ids, hex(ord(c))
    assert bpe.fast_encoder(public_tokenizers.path("word_bpe_49k.json")) is None


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400))
def test_cuts_add_up(t):
    t = t.encode("utf-8", "ignore").decode()
    assert "".join(c for c, _ in bpe.cut(t)) == t


def test_chunks_are_encoded_once(tok):
    enc, rng = bpe.ChunkEncoder(tok), random.Random(1)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 99)) for _ in range(4000))
    enc.encode([passage])
    made = enc.made
    enc.encode(["Another start. " + passage, passage + " another end"])
    assert enc.used > 2 * made and enc.made <= made + 6


def _votes(words, k=3):
    sh = [" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "Ünï Ç a\x0bb\x0cc d", "x " * 5000])
def test_fingerprint(text):
    words = (text or "").encode().lower().decode().replace("\x0b", " ").replace("\x0c", " ").split(" ")
    assert simhash.fingerprint(text) == _votes([w for x in words for w in x.replace("\n", " ").replace("\t", " ").split(" ") if w])


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_ring_keys_lose_no_pair(distance):
    keys, rng = simhash.ring_keys(distance), random.Random(distance)
    for _ in range(4000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance)))
        assert any(x & mask == 0 and all((x & c).bit_count() <= most for c, most in budgets) for mask, budgets in keys)


def test_trie():
    t = urls.RuleTrie([("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
                       ("block", "x.org", "/a"), ("allow", "x.org", "/a/b"), ("allow", "y.org", ""), ("block", "y.org", "")])
    for host, path, want in [("a.com", "/", "com/"), ("com", "/x", "com/"), ("a.com", "", None), ("example.com", "/en/1", "example.com/en/"),
                             ("b.www.example.com", "/en/1", "www.example.com/en/"), ("example.com", "/en", "com/"), ("notexample.com", "/en/", "com/"),
                             ("z.net", "/es/", "net/es/"), ("z.net", "/fr/", None), ("", "", None), ("x.org", "/abc", "x.org/a"), ("x.org", "/a/b/c", "x.org/a/b"),
                             ("x.org", "/a/c", "x.org/a"), ("a.com:80", "/", None), ("y.org", "/q", "y.org")]:
        found = t.find(host, path)
        assert (found and found[0]) == want, (host, path, found)
    assert t.find("y.org", "")[1] == "block"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.sampled_from("abc"), max_size=25)), max_size=8))
def test_suffix_automaton(seqs):
    seqs, n = [(d, [x.encode() for x in s]) for d, s in seqs], 3
    auto, least = substring.SuffixAutomaton(), {}
    for d, s in seqs:
        auto.add(s, d)
        for i in range(len(s) - n + 1):
            w = tuple(s[i: i + n])
            least[w] = min(least.get(w, d), d)
    auto.finish()
    for d, s in seqs:
        assert auto.earlier(s, d, n) == [i for i in range(len(s) - n + 1) if least[tuple(s[i: i + n])] < d]


def test_samples_are_content_defined(monkeypatch):
    rng = np.random.default_rng(0)
    raw = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    whole = {x: int(p) - x for p, a, b, _ in zip(*map(np.concatenate, zip(*suffix.sampled(raw, 40)))) for x in range(a, b + 1)}
    assert sorted(whole) == list(range(2961))
    for x in range(0, 2900, 7):  # the sampled position depends on the window alone
        (p, _, _, _), = suffix.sampled(raw[x: x + 40], 40)
        assert whole[x] == p[0]
    monkeypatch.setattr(suffix, "BLOCK", 100)
    cut = {x: int(p) - x for p, a, b, _ in zip(*map(np.concatenate, zip(*suffix.sampled(raw, 40)))) for x in range(a, b + 1)}
    assert cut == whole


def test_runs_and_characters():
    assert suffix.removed_runs(np.array([0, 3, 20, 26]), np.array([1, 3, 20, 26]), 5).tolist() == [[0, 8], [20, 25], [26, 31]]
    assert suffix.removed_runs(np.array([0, 5]), np.array([0, 5]), 5).tolist() == [[0, 10]]
    raw = "aéb€c".encode()
    assert suffix.whole_characters(raw, np.array([[2, 6]])).tolist() == [[3, 4]]
    assert suffix.whole_characters(raw, np.array([[1, 7]])).tolist() == [[1, 7]]
