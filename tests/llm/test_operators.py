"""Operators against brute force, and on nulls, empty and very long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coursepulse.llm import (
    chat,
    exact_dedup,
    html,
    jaccard_join,
    line_dedup,
    packing,
    pieces,
    quality,
    toxicity,
    warc,
)
from coursepulse.llm.agenda import NEVER
from coursepulse.llm.components import components
from coursepulse.llm.scratch import scratch_path
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_copies(seed, groups=12, size=7, words=40):
    """Random texts, each with copies of more and more changed words, and a passage that some share."""
    r = random.Random(seed)
    draw = lambda n: [f"w{r.randint(0, 4000)}" for _ in range(n)]
    passage, out = draw(15), []
    for g in range(groups):
        base = draw(words)
        for k in range(size):
            text = list(base)
            for _ in range(k):
                text[r.randrange(len(text))] = f"n{r.randint(0, 99999)}"
            out.append(" ".join(text + (passage if (g + k) % 3 == 0 else [])))
    r.shuffle(out)
    return list(enumerate(out, start=1))


# --- quality rules

def brute_quality(text):
    text = text or ""
    w, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_quality_counts_and_cascade(spark, edge, empty):
    rows = quality.judge(edge).collect()
    assert sorted((r.doc_id, *r[1:6]) for r in rows) == sorted((i, *brute_quality(t)) for i, t in EDGE)
    verdict = {r.doc_id: r.kept for r in rows}
    kept = quality.keep_documents(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}
    assert quality.judge(empty).count() == 0 and quality.keep_documents(empty).count() == 0


def test_rule_order_changes_no_verdict(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    a = pa.array(texts)
    want = quality.run_cascade(a, quality.RULES)
    r = random.Random(1)
    for _ in range(4):
        assert (quality.run_cascade(a, r.sample(quality.RULES, len(quality.RULES))) == want).all()


# --- packing

def test_packing_places_every_token(spark, edge, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = {}
    for i, t in EDGE:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for p in range(0, len(ids), 4096):
            want[i, p // 4096] = (p, len(ids[p:p + 4096]), zlib.crc32(np.array(ids[p:p + 4096], "<u4").tobytes()))
    rows = packing.pack(edge).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want) + 1  # the repeated row is packed as well
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= -(-sum(r.length for r in rows) // 4096) + 1
    assert packing.pack(empty).count() == 0


def test_sequences_hold_the_placed_ids(spark, docs):
    src = docs([(i, f"some words {i} " * (i * 9)) for i in range(1, 12)])
    placed = packing.pack(src, capacity=256)
    ids = {(r.doc_id, r.piece): bytes(r.ids) for r in packing.tokenise(src, capacity=256).collect()}
    seqs = {r.sequence_id: bytes(r.ids) for r in packing.sequences(src, placed, capacity=256).collect()}
    for r in placed.collect():
        assert seqs[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == ids[r.doc_id, r.piece]


@pytest.mark.parametrize("seed", range(30))
def test_bin_completion_is_valid_and_not_worse_than_best_fit(seed):
    r = random.Random(seed)
    cap = r.randint(10, 50)
    counts = Counter(r.randint(1 if seed % 2 else cap // 4, cap) for _ in range(r.randint(1, 40)))
    best, bound = packing.bin_completion(counts, cap, 3000)
    placed = Counter()
    for pattern, bins in best:
        assert sum(s * c for s, c in pattern) <= cap
        for s, c in pattern:
            placed[s] += c * bins
    assert placed == counts
    assert bound <= sum(k for _, k in best) <= sum(k for _, k in packing.best_fit(counts, cap))


# --- SentencePiece

def test_pieces_equal_the_library_without_dropout_and_decode(spark, edge, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    plain = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in pieces.encode(edge, dropout=0.0).collect()}
    assert all(plain[i] == sp.encode(t or "") for i, t in EDGE if "▁" not in (t or ""))
    back = pieces.decode(pieces.encode(edge, dropout=0.3))
    again = pieces.decode(pieces.encode(edge.repartition(5), dropout=0.3)).collect()
    rows = back.collect()
    assert sorted((r.doc_id, r.decoded) for r in rows) == sorted((i, t or "") for i, t in EDGE)
    assert sorted((r.doc_id, bytes(r.ids)) for r in rows) == sorted((r.doc_id, bytes(r.ids)) for r in again)
    other = {r.doc_id: bytes(r.ids) for r in pieces.encode(edge, dropout=0.3, seed=5).collect()}
    assert any(bytes(r.ids) != other[r.doc_id] for r in rows)
    assert pieces.encode(empty).count() == 0


def test_dropout_follows_a_plain_agenda(spark):
    """The array steps against one word's agenda run by hand, with the same keyed skips."""
    from coursepulse.llm.agenda import PairTable, merge_all

    r = random.Random(3)
    merges = [(0, 1, 0, 4), (1, 2, 1, 5), (4, 2, 2, 6), (2, 2, 3, 7), (0, 0, 4, 8), (5, 0, 5, 9), (7, 6, 6, 10)]
    table = PairTable(merges)
    known = {(a, b): (k, c) for a, b, k, c in merges}
    drop = lambda a, b, p: (a * 31 + b * 17 + p * 7) % 5 == 0
    words = [[r.randint(0, 3) for _ in range(r.randint(0, 9))] for _ in range(200)]
    offs = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    got, ends = merge_all(np.array(sum(words, [])), offs, table, lambda a, b, p: drop(a.astype(int), b.astype(int), p))
    for i, w in enumerate(words):
        syms = [(s, offs[i] + k) for k, s in enumerate(w)]
        while True:
            best = min(((known[a, b][0], k) for k, ((a, p), (b, _)) in enumerate(zip(syms, syms[1:]))
                        if (a, b) in known and not drop(a, b, p)), default=None)
            if best is None:
                break
            k = best[1]
            syms[k:k + 2] = [(known[syms[k][0], syms[k + 1][0]][1], syms[k][1])]
        assert got[ends[i]:ends[i + 1]].tolist() == [s for s, _ in syms]


def test_dropout_varies_with_every_occurrence(spark, docs):
    """A frequent word gets more segmentations the more often it occurs, across and within documents."""
    def kinds(rows, words):
        got = pieces.encode(docs([(i, " ".join(["internationalization"] * words)) for i in range(rows)])).collect()
        model = pieces.PieceModel(pieces.default_model())
        seen = Counter()
        for r in got:
            ids, word = np.frombuffer(r.ids, "<u4").astype(int), ()
            for k in ids:
                if model.spelled[model.spelled_ends[k]] == 32 and word:
                    seen[word], word = seen[word] + 1, ()
                word += (k,)
            seen[word] += 1
        assert sum(seen.values()) == rows * words
        return len(seen)

    few, more, most = kinds(8, 5), kinds(40, 20), kinds(400, 20)
    assert 4 < few < more < most
    assert kinds(1, 800) > few


def alone(model, word, marks, name, number, dropout):
    """The pieces of one occurrence of a word by an agenda run by hand."""
    sym = model.spread(pa.array([word]), np.array([marks]))[0]
    spelling = pieces._mixed(sym.view(np.uint64) * pieces._K[0] + np.arange(len(sym)).astype(np.uint64) * pieces._K[1]).sum()
    key = pieces.keyed(pieces.SEED, np.array([name]), np.array([number]), np.array([spelling]).view(np.int64))
    limit = min(int(dropout * 2.0 ** 64), 2 ** 64 - 1)

    def rank(left, right, place):
        got, to = model.table.find(np.array([left]), np.array([right]))
        pair = np.array([(left << 32) | right]).astype(np.uint64)
        h = pieces._mixed(key + np.array([place]).astype(np.uint64) * pieces._K[2] + pair * pieces._K[3])
        return None if got[0] == NEVER or int(h[0]) < limit else (int(got[0]), int(to[0]))

    syms = [(int(s), k) for k, s in enumerate(sym)]
    while True:
        found = [(rank(a, b, p), k) for k, ((a, p), (b, _)) in enumerate(zip(syms, syms[1:])) if a >= 0 and b >= 0]
        best = min(((r[0], k, r[1]) for r, k in found if r), default=None)
        if best is None:
            break
        _, k, to = best
        syms[k:k + 2] = [(to, syms[k][1])]
    return model.with_bytes(np.array([s for s, _ in syms]), np.array([0, len(syms)]))[0].tolist()


@pytest.mark.parametrize("dropout", [0.05, 0.4, 1.0])
def test_shared_words_equal_each_occurrence_merged_alone(monkeypatch, dropout):
    model, r = pieces.PieceModel(pieces.default_model()), random.Random(5)
    words = ["nation", "internationalization", "a", "the", "Ünïcode", "한국", "mississippi", "tree\nhouse", "x▁y", "there"]
    texts = [" ".join(r.choice(words) for _ in range(20)) for _ in range(30)] + ["", " the  the ", "the"]
    names = np.arange(len(texts)) * 7919
    ids, offs = model.encode(pa.array(texts), names, dropout)
    for i, text in enumerate(texts):
        split, marks = pieces._split_runs(text)
        want = [k for number, (w, m) in enumerate(zip(split, marks)) for k in alone(model, w, m, int(names[i]), number, dropout)]
        assert ids[offs[i]:offs[i + 1]].tolist() == want
    monkeypatch.setattr(pieces, "AT_ONCE", 50)  # in many portions
    again, ends = model.encode(pa.array(texts), names, dropout)
    assert again.tolist() == ids.tolist() and ends.tolist() == offs.tolist()


# --- exact dedup

def test_exact_groups(spark, edge, empty):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in EDGE:
        groups[plain(t)].append((-len(t or ""), i))
    want = sorted((i, min(groups[plain(t)])[1], len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in EDGE)
    rows = exact_dedup.exact_groups(edge).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    left = exact_dedup.keep_one(edge)
    assert left.columns == edge.columns and left.count() == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_long_texts_that_differ_late(spark, docs):
    base = "x" * 70_000
    rows = [(1, base + "a"), (2, base + "b"), (3, base + " a"), (4, base[:-1] + "y" + "a"), (None, "q"), (None, "q"), (5, base + "b")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs(rows)).collect()}
    assert {(1, 3, 2, False), (3, 3, 2, True), (2, 2, 2, True), (5, 2, 2, False), (4, 4, 1, True)} <= got
    assert (None, None, 2, True) in got


# --- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body><header>top</header>
<nav><ul><li>menu</ul></nav><div class="ad box">buy</div><div id="cookie-notice">we use</div><article><h1>A &amp; B</h1>
<p><b>One   two<br><p>Three&nbsp;four &#x41;<div class="comments"><p>nice!</div><ul><li>x<li>y</ul><form>f</form></article>
<aside>side</aside><footer>&copy; end</footer>"""


def test_page_text(spark, empty):
    assert html.page_text(PAGE) == "A & B\nOne two\nThree four A\nx\ny"
    rows = [(1, "http://h.example/a", PAGE), (1, "http://h.example/a", PAGE), (2, None, None), (3, "x", ""),
            (4, "http://h.example/b", "<p>cut &am"), (5, "http://h.example/c", "<div>" * 3000 + "deep" + "<article>" + "long " * 50_000)]
    src = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, m long")
    got = sorted((r.page_id, r.text[:9]) for r in html.extract(src).collect())
    assert got == [(1, "A & B\nOne"), (1, "A & B\nOne"), (2, ""), (3, ""), (4, "cut &am"), (5, "deep\nlong")]
    assert html.extract(src.limit(0)).count() == 0


def test_style_tree_removes_what_a_site_repeats(spark):
    page = lambda i, k: f"<body><div class=x1>Same words on each page</div><div class=x2>Story {i} of host {k} is new</div></body>"
    rows = [(100 * k + i, f"http://h{k}.example/{i}", page(i, k)) for k in range(2) for i in range(40)]
    src = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (100_000, 0):  # sent to the tasks, or joined by host
        got = {r.page_id: r.text for r in html.extract(src, max_sent=most).collect()}
        assert got == {i: f"Story {i % 100} of host {i // 100} is new" for i, _, _ in rows}


def test_large_site_with_many_bodies_keeps_its_stories(spark):
    """The body's children vary little for the number of pages; its stories still are the content."""
    def page(i):
        few = "".join(f"<div class=b{k}></div>" for k in range(30) if k == i // 10 % 30)
        return f"<html><body>Same top{few}<div class=s>Story {i} is new</div><div class=z>Same words</div></body></html>"

    rows = [(i, f"http://big.example/{i}", page(i if i % 10 == 0 else 0)) if i % 10 else (i, f"http://big.example/{i}", page(i))
            for i in range(20_000)]
    rows = [(i, u, p.replace("Story 0 ", f"Story {i} ")) for i, u, p in rows]
    src = spark.createDataFrame(rows, "page_id long, url string, html string")
    for some in (src, src.where("page_id < 40")):
        got = {r.page_id: r.text for r in html.extract(some).collect()}
        assert len(got) == some.count() and all(t == f"Story {i} is new" for i, t in got.items())


def test_importance_is_rolled_up_and_all_hosts_tree_is_for_small_hosts(spark):
    page = lambda i: f"<div class=a><p>Same</p><div class=b><p>New {i}</p></div></div>"
    src = spark.createDataFrame([(f"http://h/{i}", page(i)) for i in range(64)], "url string, html string")
    got = {r.path: r for r in html.importance(html._counts(src)).where("host = 'h'").collect()}
    same, new = got[">div.a>p>#text"], got[">div.a>div.b>p>#text"]
    assert same.importance == pytest.approx(0) and new.importance == pytest.approx(1)
    # one presentation each: 0.9 of the mean of the children
    assert got[">div.a>div.b"].importance == pytest.approx(0.9 ** 2) and got[">div.a>p"].importance == pytest.approx(0)
    assert got[">div.a"].importance == pytest.approx(0.9 * 0.9 ** 2 / 2) and got[""].highest == pytest.approx(1)
    assert got[">div.a>p"].highest == pytest.approx(0)
    # most hosts repeat div.x, one large host has it anew on each page; a small host is judged by all
    rows = [(1000 * k + i, f"http://s{k}/{i}", "<div class=x>Hello</div>") for k in range(100) for i in range(15)]
    rows += [(-1 - i, f"http://large/{i}", f"<div class=x>Tale {'A' * (i + 1)}</div>") for i in range(16)]
    one = spark.createDataFrame(rows + [(-100, "http://s0/x", "<div class=x>Hello</div><p>own</p>")], "page_id long, url string, html string")
    for most in (100_000, 0):
        texts = {r.page_id: r.text for r in html.extract(one, threshold=0.99, max_sent=most).collect()}
        assert all(texts[-1 - i] == f"Tale {'A' * (i + 1)}" for i in range(16)) and texts[1000] == ""


def test_names_are_a_weak_prior_and_articles_are_judged(spark):
    def page(i):
        return (f"<nav>go {i}</nav><div class=header>Same head</div><div class=widget>Own words {i}</div><article>"
                f"<div class='entry-header'><h1>Title {i}</h1></div><section class='related-work'>Others {i}</section>"
                f"<p>Story {i}</p><div class=box>Read more here</div></article>")

    def want(i, judged):
        return [*([f"Own words {i}"] if judged else []), f"Title {i}", f"Others {i}", f"Story {i}", *([] if judged else ["Read more here"])]

    assert html.page_text(page(7)).split("\n") == want(7, False)  # no tree: the priors rule
    rows = [(i, f"http://h/{i}", page(i)) for i in range(40)]
    copies = [(100 + i, f"http://copies/{i}", page(7)) for i in range(20)]  # repeated as a whole
    src = spark.createDataFrame(rows + copies, "page_id long, url string, html string")
    for most in (100_000, 0):
        got = {r.page_id: r.text.split("\n") for r in html.extract(src, max_sent=most).collect()}
        assert all(got[i] == want(i, True) for i in range(40))
        assert all(got[100 + i] == want(7, False) for i in range(20))


# --- WARC

def test_archives_give_back_their_pages(spark):
    body = "é<p>line\r\n\r\nWARC/1.1\r\n" * 4000
    rows = [(1, "http://a/\n1", body), (5, "http://a/5", body), (3, None, None), (4, "u", "short"), (9, "u", "short"),
            (None, "n", "x" * 1500), (2, "u", body + "!")]
    src = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, size long, digest string")
    path = scratch_path(spark, "warc-test")
    warc.write_archive(src, path, segment_bytes=5000)
    got = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert all(r.problem is None for r in got.values()) and len(got) == len(rows)
    for i, _, page in rows:
        r, data = got[None if i is None else str(i)], (page or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        if i == 1:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", "5", None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, data)
    none = scratch_path(spark, "warc-none")
    warc.write_archive(src.limit(0), none)
    assert warc.read_archive(spark, none).count() == 0


def test_damaged_segments_are_reported(spark):
    path = scratch_path(spark, "warc-cut")
    warc.write_archive(spark.createDataFrame([(1, "u", "y" * 9000)], "page_id long, url string, html string"), path, segment_bytes=2000)
    records = warc.read_records(spark, path)
    assert warc.reassemble(records.where("coalesce(segment, 0) <> 2")).first().problem == "segments are missing or repeated"
    assert warc.reassemble(records.where("total is null")).first().problem == "no last segment"
    assert warc.reassemble(records).first().problem is None


# --- line dedup

def brute_lines(rows, least):
    rows = sorted(rows)
    seqs = [[(k, x, len(WORD.findall(x))) for k, x in enumerate(t.split("\n")) if WORD.search(x)] for _, t in rows]
    first, runs = {}, []
    for d, s in enumerate(seqs):
        for a in range(len(s)):
            words = 0
            for b in range(a, len(s)):
                words += s[b][2]
                if words >= least:
                    key, pos = tuple(x[1] for x in s[a:b + 1]), (rows[d][0], s[a][0])
                    first[key] = min(first.get(key, pos), pos)
                    runs.append((key, pos, d, {s[k][0] for k in range(a, b + 1)}))
    gone = defaultdict(set)
    for key, pos, d, lines in runs:
        if pos > first[key]:
            gone[d] |= lines
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, (i, t) in enumerate(rows)}


@pytest.mark.parametrize("seed", [1, 4])
def test_line_runs_against_all_runs(spark, seed):
    r = random.Random(seed)
    pool = [" ".join(r.choice("abcdef") for _ in range(r.randint(0, 5))) for _ in range(6)]
    rows = [(i * 3, "\n".join(r.choice(pool) if r.random() < .9 else f"u{r.randint(0, 9999)}" for _ in range(r.randint(0, 14))))
            for i in range(25)]
    least = r.randint(3, 10)
    src = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.text for x in line_dedup.dedup_lines(src, least).collect()} == brute_lines(rows, least)


def test_line_dedup_edges(spark, edge, empty):
    got = line_dedup.dedup_lines(edge, 10).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(EDGE) and by[0].text == "" and by[3].n_deleted == 0 and by[2].text == " \n\t "
    assert [r.n_deleted for r in got if r.doc_id == 4] == [0, 0]  # repeats of a row are no copies of each other
    assert line_dedup.dedup_lines(empty).count() == 0


# --- chat

def test_reply_trees(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad </s>", 1.0), ("t", 3, 1, "assistant", "good <|end|>", 2.0),
            ("t", 4, 3, "user", "more & |", None), ("t", 5, 4, "assistant", None, 9.0), (None, 1, 77, None, "lone", 1.0)]
    src = spark.createDataFrame([(*r, 1) for r in rows], "tree string, node long, parent long, role string, text string, score double, up long")
    both = {(r.tree, r.branch_rank): r for r in chat.read_back(chat.format_paths(src, branches=2)).collect()}
    assert set(both) == {("t", 1), ("t", 2), (None, 1)}
    assert [tuple(x) for x in both["t", 1].turns] == [("user", "q"), ("assistant", "good <|end|>"), ("user", "more & |"), ("assistant", "")]
    assert [tuple(x) for x in both["t", 2].turns] == [("user", "q"), ("assistant", "bad </s>")]
    assert both["t", 1].loss_text == "good <|end|>" and both[None, 1].loss_text == ""
    assert chat.format_paths(src.limit(0)).count() == 0


def test_long_and_cyclic_trees(spark):
    chain = spark.range(1, 301).selectExpr("0L AS tree", "id AS node", "if(id > 1, id - 1, null) AS parent", "'user' AS role",
                                           "string(id) AS text", "0D AS score")
    assert chat.format_paths(chain).first().n_turns == 300
    cycle = spark.createDataFrame([(0, 1, 2, "u", "a", 0.0), (0, 2, 1, "u", "b", 0.0)],
                                  "tree long, node long, parent long, role string, text string, score double")
    old, chat.MAX_ROUNDS = chat.MAX_ROUNDS, 3
    with pytest.raises(ValueError):
        chat.format_paths(cycle)
    chat.MAX_ROUNDS = old


# --- toxicity

def test_toxicity_learns_outside_the_held_out_fold(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rows = toxicity.scores(docs, labels).collect()
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)
    # labels of the held-out fold change nothing
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.scores(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-12 for r in rows)


def test_toxicity_edges(spark, edge, empty):
    labels = spark.createDataFrame([(i, 1, int(i == 3)) for i, _ in EDGE] + [(4, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.scores(edge, labels).count() == len(EDGE)
    assert toxicity.keep_clean(edge, labels.limit(0)).count() == len(EDGE)
    assert toxicity.keep_clean(edge, labels.limit(0)).columns == edge.columns
    assert toxicity.scores(empty, labels).count() == 0


# --- Jaccard join

def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("seed,region_rows", [(1, 3000), (2, 6), (3, 2)])
def test_jaccard_components(spark, docs, seed, region_rows):
    rows = near_copies(seed) + [(1000, None), (1001, ""), (1002, "a B"), (1003, "A b"), (1004, " ")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(docs(rows), region_rows=region_rows).collect()}
    assert got == brute_components(rows)


def test_jaccard_edges(spark, edge, empty):
    got = jaccard_join.join_documents(edge).collect()
    want = brute_components(EDGE)
    assert len(got) == len(EDGE) and all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)
    left = jaccard_join.keep_one(edge)
    assert left.columns == edge.columns
    assert {r.doc_id for r in left.collect()} == {i for i, (_, c) in want.items() if c == i}
    assert jaccard_join.join_documents(empty).count() == 0


def test_region_join_is_exact():
    for seed in range(8):
        rows = near_copies(seed, groups=3, size=12, words=24)
        sets = list(jaccard_join.shingle_sets(pa.array([t for _, t in rows])))
        got = jaccard_join.join_region(sets)
        want = brute_components(rows)
        part = lambda f: {frozenset(i for i in range(len(rows)) if f(i) == c) for c in {f(i) for i in range(len(rows))}}
        assert part(lambda i: got[i]) == part(lambda i: want[rows[i][0]][1])


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.vertex: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


# --- repeated ids, long unbroken texts

def test_equal_ids_with_other_texts(spark, docs):
    a, b = "x" * 80 + "A" * 20, "x" * 80 + "B" * 20  # of one length, different after the first digit only
    rows = [(1, a), (2, a + " "), (1, b), (3, b), (None, a), (None, b), (1, a)]
    got = exact_dedup.exact_groups(docs(rows)).collect()
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in (a, b)}
    assert sorted((str(r.doc_id), sha[r.text_sha256][-1], r.keep_id, r.group_size, r.kept) for r in got) == sorted([
        ("1", "A", 2, 4, False), ("1", "A", 2, 4, False), ("2", "A", 2, 4, True), ("None", "A", 2, 4, False),
        ("1", "B", None, 3, False), ("3", "B", None, 3, False), ("None", "B", None, 3, True)])
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.keep_one(docs(rows)).collect()) == [("2", a + " "), ("None", b)]
    late = [(1, "p" * 100 + "A"), (2, "p" * 100 + "A "), (1, "q" * 100 + "A"), (3, "q" * 100 + "A")]
    assert sorted((r.doc_id, r.text) for r in exact_dedup.keep_one(docs(late)).collect()) == [(1, "q" * 100 + "A"), (2, "p" * 100 + "A ")]


def test_pages_that_repeat_an_id_keep_their_rows(spark):
    long = "a line of html\n" * 2500
    rows = [(7, "u", long), (7, "u", long), (8, "u", long + "1"), (8, "u", long + "2"), (None, "u", long + "3"), (None, "u", long + "4"),
            (6, "u", long), (9, "v", "short"), (9, "v", "short")]
    src = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-again")
    warc.write_archive(src.repartition(3), path)
    got = warc.read_archive(spark, path).collect()
    assert all(r.problem is None for r in got) and len(got) == len(rows)
    want = sorted((str(i), len(t), "revisit" if i == 6 else "response") for i, _, t in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.record_type) for r in got) == want
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {t for _, _, t in rows}
    assert [r.refers_to for r in got if r.record_type == "revisit"] == ["7"]
    ids = [r.origin for r in warc.read_records(spark, path).where("segment is null or segment = 1").collect()]
    assert len(ids) == len(set(ids)) == len(rows)


@pytest.mark.parametrize("seed", range(8))
def test_long_words_merge_as_one_by_one(monkeypatch, seed):
    """All safe merges at once against one merge a step, with and without keyed skips."""
    from coursepulse.llm import agenda

    r = random.Random(seed)
    words = {c: (c,) for c in range(4)}  # tokens as strings of symbols; ranks in no order of length
    merges, ranks = [], r.sample(range(400), 400)
    for _ in range(r.choice([15, 60])):
        a, b = r.choice(sorted(words)), r.choice(sorted(words))
        if len(words[a]) + len(words[b]) <= 6 and (a, b) not in {m[:2] for m in merges}:
            same = next((k for k, v in words.items() if v == words[a] + words[b]), None)
            new = len(words) if same is None else same
            words[new] = words[a] + words[b]
            merges.append((a, b, ranks.pop(), new))
    table = agenda.PairTable(merges)
    assert table.longest <= 6
    drop = lambda a, b, p: (a.astype(int) * 31 + b.astype(int) * 17 + p.astype(int) * 7) % 5 == 0
    texts = [[r.randint(-1 if r.random() < .02 else 0, 3) for _ in range(n)] for n in (700, 3, 900, 1, 0, 40, 650)]
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat = np.array(sum(texts, []))
    for skip in (None, drop):
        seen: list = [[], []]
        got = agenda.merge_all(flat, offs, table, skip, seen[0])
        monkeypatch.setattr(agenda, "LONG", 10 ** 9)
        want = agenda.merge_all(flat, offs, table, skip, seen[1])
        monkeypatch.undo()
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
        made = [sorted(zip(*(np.concatenate(x).tolist() for x in zip(*s)))) for s in seen]
        assert made[0] == made[1] and len(made[0]) > 100


def test_a_text_of_two_megabytes_without_spaces(spark):
    import time

    import sentencepiece
    from tokenizers import Tokenizer

    r = random.Random(1)
    text = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=2_000_000))
    start = time.monotonic()
    ids, _ = packing.WordTokenizer(packing.default_tokenizer()).encode(pa.array([text, "a b"]))
    model = pieces.PieceModel(pieces.default_model())
    plain, offs = model.encode(pa.array([text, "a b"]), np.array([1, 2]), 0.0)
    dropped, _ = model.encode(pa.array([text[:200_000]]), np.array([1]), 0.1)
    assert time.monotonic() - start < 120
    assert ids[:-2].tolist() == Tokenizer.from_file(packing.default_tokenizer()).encode(text, add_special_tokens=False).ids
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert plain[:offs[1]].tolist() == sp.encode(text) and len(dropped) > 0


# --- bin completion against an exact solver

def fewest_bins(pieces_, capacity):
    """Exact: for every set of pieces the least (bins, load of the last bin), piece by piece."""
    n = len(pieces_)
    best = {0: (1, 0)}
    for mask in range(1, 1 << n):
        options = []
        for i in range(n):
            if mask >> i & 1:
                bins, load = best[mask & ~(1 << i)]
                options.append((bins, load + pieces_[i]) if load + pieces_[i] <= capacity else (bins + 1, pieces_[i]))
        best[mask] = min(options)
    return best[(1 << n) - 1][0] if n else 0


@pytest.mark.parametrize("seed", range(20))
def test_bin_completion_equals_an_exact_solver(seed):
    r = random.Random(seed)
    for _ in range(20):
        cap = r.randint(8, 120)
        items = [r.randint(1 if r.random() < .5 else cap // 5 + 1, cap if r.random() < .3 else cap // 2) for _ in range(r.randint(0, 10))]
        found = packing.complete(Counter(items), cap)
        assert found.proven and found.bins == fewest_bins(items, cap) == sum(k for _, k in found.patterns)
        assert Counter({s: c for s, c in Counter(s for p, k in found.patterns for s, c in p for _ in range(c * k)).items()}) == Counter(items)


def test_bin_completion_finds_fillings_of_no_large_piece():
    found = packing.complete(Counter([100, 59, 59, 59, 40, 35, 25, 23]), 200)
    assert (found.bins, found.bound, found.proven) == (2, 2, True)
    short = packing.complete(Counter([100, 59, 59, 59, 40, 35, 25, 23]), 200, steps=3)
    assert (short.bins, short.bound, short.proven) == (3, 2, False)
    tight = packing.complete({50 + i: 1 for i in range(20)} | {30 + i: 2 for i in range(15)}, 130)
    assert tight.bound <= tight.bins <= sum(k for _, k in packing.best_fit({50 + i: 1 for i in range(20)} | {30 + i: 2 for i in range(15)}, 130))
    assert packing.complete({}, 10) == ([], 0, 0, True)


# --- chat edges

def test_chat_ties_repeats_and_long_texts(spark):
    long = "<|end|> & | é\n" * 60_000
    rows = [("t", i, i - 1 if i > 1 else None, "assistant" if i % 2 == 0 else "user", f"m{i}", 0.0) for i in range(1, 9)]
    rows += [rows[3], ("t", 5, 4, "user", "m4b", 0.0)]  # one row repeated, one node with two texts
    rows += [("tie", 1, None, "user", "q", 1.0), ("tie", 2, 1, "assistant", "a", 1.0), ("tie", 3, 1, "assistant", "b", 1.0),
             ("long", 1, None, "user", long, None), ("long", 2, 1, "assistant", long, None)]
    src = spark.createDataFrame([(*r, 1) for r in rows], "tree string, node long, parent long, role string, text string, score double, again long")
    got = {r.tree: r for r in chat.read_back(chat.format_paths(src.repartition(3))).collect()}
    assert got["t"].n_turns == 8 and [x.text for x in got["t"].turns] == ["m1", "m2", "m3", "m4", "m4b", "m6", "m7", "m8"]
    assert got["t"].loss_text == "m2m4m6m8"
    assert (got["tie"].leaf, got["tie"].loss_text) == (2, "a")  # equal scores: the smaller leaf
    assert [x.text for x in got["long"].turns] == [long, long] and got["long"].loss_text == long
    both = chat.chain(spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "user", "z")],
                                            "conv_id long, turn long, role string, text string"))
    assert {(r.tree, r.n_turns) for r in chat.format_paths(both).collect()} == {(1, 3), (None, 1)}


def test_line_numbers_beyond_22_bits_and_many_deleted_lines(spark):
    """Positions order by document, then line, however many lines a text has."""
    few = "\n".join(f"line {i} of the passage" for i in range(30))
    src = spark.createDataFrame([(1, "\n" * 4_200_000 + few), (2, few + "\nown words")], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_deleted) for r in line_dedup.dedup_lines(src, 50).collect()}
    assert got == {1: (4_200_030, 0), 2: (31, 30)}


# --- site style trees against a plain one

def plain_importance(rows):
    """Importance of every node of one host's tree, by recursion over merged trees of the pages."""
    from collections import Counter
    from math import log

    pages_of, texts, styles, place = Counter(), {}, {}, {}
    sums = {}
    for page in rows:
        tree = html.PageTree(elements=True).read(page)
        nodes, leaves, chars, shapes, said = set(), {}, Counter(), set(), set()
        for node, kinds in tree.elements:
            if node.kind != html.HIDDEN:
                nodes.add(node.path)
                shapes.add((node.path, kinds))
                chars[node.path] += node.chars
                place[node.path] = node
        rival = any(n.outer is not None for n, _ in tree.elements if n.kind != html.HIDDEN)
        for node, text, linked in tree.blocks:
            if node.kind == html.HIDDEN:
                continue
            leaf = html._below(node.path, html.TEXT)
            place[leaf] = node
            nodes.add(leaf)
            said.add((leaf, text))
            a, b, _ = leaves.get(leaf, (0, 0, node))
            leaves[leaf] = (a + len(text), b + linked, node)
        for leaf, (a, b, node) in leaves.items():
            held = node
            while held.tag in html.FLOW and held.up is not None:
                held = held.up
            old = sums.get(leaf, (0, 0.0, 0.0))
            sums[leaf] = (old[0] + rival, old[1] + chars[held.path] / chars[""], old[2] + b / a)
        pages_of.update(nodes)
        for leaf, text in said:
            texts.setdefault(leaf, Counter())[text] += 1
        for path, kinds in shapes:
            styles.setdefault(path, Counter())[kinds] += 1

    def value(path):
        m = pages_of[path]
        if path in texts:
            h = 1.0 if m <= 1 else 1 - sum(map(log, texts[path].values())) / len(texts[path]) / log(m)
            rival, mass, links = (x / m for x in sums[path])
            kind = place[path].kind
            if kind == html.CONTENT:
                return html.BONUS + (1 - html.BONUS) * h * (1 - links / 2)
            if kind == html.RARELY:
                return html.NAMED * h * (1 - links) * mass * (1 - rival)
            return (html.WEAK if kind == html.PERHAPS else 1) * h * (1 - links) * min(1.0, mass / html.FULL_MASS)
        if path not in styles:
            return 0.0
        got = styles[path]
        n, share = sum(got.values()), html.DECAY ** len(got)
        own = 1.0 if n <= 1 else (log(n) - sum(c * log(c) for c in got.values()) / n) / log(n)
        below = sum(c / n * sum(value(html._below(path, k)) for k in kinds.split(",")) / len(kinds.split(","))
                    for kinds, c in got.items() if kinds)
        return (1 - share) * own + share * below

    return {path: value(path) for path in pages_of}


def random_site(seed):
    import random

    r = random.Random(seed)
    word = lambda n: " ".join(r.choice("alpha beta gamma delta omega".split()) for _ in range(n))

    def branch(depth):
        tag = r.choice(["div", "div class=box", "section id=side", "p", "nav", "article", "footer", "div class=related", "ul"])
        inner = "".join(branch(depth - 1) for _ in range(r.randrange(3))) if depth else ""
        link = f"<a href=x>{word(2)}</a>" if r.random() < 0.4 else ""
        return f"<{tag}>{word(r.randrange(4))}{link}{inner}</{tag.split()[0]}>"

    shapes = [branch(3) + branch(2) for _ in range(3)]
    return [r.choice(shapes).replace("alpha", r.choice(["alpha", f"new{i}"])) for i in range(30)]


@pytest.mark.parametrize("seed", range(4))
def test_style_tree_equals_a_plain_one(spark, seed):
    deep = "<div class=one-of-many-wrappers>" * (seed * 10)  # paths that go on from their digests
    site = [deep + p for p in random_site(seed)]
    src = spark.createDataFrame([("http://h/", p) for p in site], "url string, html string")
    got = {r.path: r.importance for r in html.importance(html._counts(src)).where("host = 'h'").collect()}
    assert got == pytest.approx(plain_importance(site))


def test_varying_menus_and_adverts_fall_without_names(spark):
    """Menus, adverts and footers that differ on each page: judged by links and mass, not by what they are called."""
    def page(i):
        links = "".join(f"<li><a href=/{i}{k}>go {i} {k}</a></li>" for k in range(5))
        return (f"<body><div class=q1><ul>{links}</ul></div><div class=q2>Buy thing {i} now</div><div class=q3><h2>Head {i}</h2>"
                f"<p>{f'Story {i} is told here. ' * 40}</p></div><div class=q4>No {i} of ours</div></body>")

    src = spark.createDataFrame([(i, f"http://h/{i}", page(i)) for i in range(40)], "page_id long, url string, html string")
    for names in (True, False):
        got = {r.page_id: r.text for r in html.extract(src, names=names).collect()}
        assert got == {i: f"Head {i}\n" + (f"Story {i} is told here. " * 40).strip() for i in range(40)}


def test_names_inside_an_article_and_around_a_page(spark):
    page = ("<article><p class=comment-count>Para</p><div class=popup-story>Told</div><div id=nav-history>Past</div>"
            "<div class=comments>nice</div></article>")
    assert html.page_text(page) == "Para\nTold\nPast"
    rows = [(i, f"http://h/{i}", page.replace("Para", f"Para {i}")) for i in range(3)]
    rows += [(100 + i, f"http://p/{i}", f"<div class=popup>{f'All of page {i}. ' * 9}</div><div class=comments>yes {i}</div>") for i in range(40)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "Para 1\nTold\nPast"
    assert all(got[100 + i] == (f"All of page {i}. " * 9).strip() for i in range(40))


def test_deep_pages_need_little_memory():
    import tracemalloc

    page = "<div>" * 100_000 + "deep" + "</x>" * 100_000 + "<li>" * 10
    tracemalloc.start()
    tree = html.PageTree(elements=True).read(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tree.blocks[0][1] == "deep" and peak < 300_000_000
