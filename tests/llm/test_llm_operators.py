"""Each operator against a plain version on awkward rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from agoralake.llm import decontaminate, embedding_dups, fuzzy_lines, mixing, quality, sharding, simhash, suffix_dedup, token_counts
from agoralake.llm.common import components
from agoralake.llm.html_text import extract_pages, main_text
from corpus_cases import DOCS, awkward, documents, prose


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links += [(r.randint(300, 360), r.randint(300, 360)) for _ in range(30)]
    r.shuffle(links)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups_of({n for a, b in links for n in (a, b) if a != b}, [(a, b) for a, b in links if a != b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1: vectors

def plain_vectors(rows, least=0.93):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    use = [(i, np.array(v, dtype=float) / np.abs(v).max(), l) for i, v, l in rows if l is not None and ok(v)]
    links = []
    for k, (i, v, l) in enumerate(use):
        for j, w, m in use[:k]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links.append((i, j))
    count = Counter(x for a, b in links for x in (a, b))
    group = groups_of([r[0] for r in rows], links)
    return {i: (count[i], group[i], group[i] == i) for i, _, _ in rows}


@pytest.mark.parametrize("leaf,part", [(256, 4096), (8, 4096), (256, 7), (8, 5)])
def test_vectors_against_all_pairs(spark, leaf, part):
    r = np.random.default_rng(1)
    rows = []
    for c in range(12):
        center = r.standard_normal(8)
        rows += [(len(rows) + k, (center + 0.05 * r.standard_normal(8)).tolist(), c % 3) for k in range(10)]
    rows += [(500 + i, v, 1) for i, v in enumerate([None, [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [], [1.0, None], [1.0, 2.0]])]
    rows += [(600, rows[0][1], 0), (601, rows[0][1], 0), (602, rows[0][1], None), (603, [2 * x for x in rows[0][1]], 0), (604, [1e-300] * 8, 2)]
    df = spark.createDataFrame([(*x, "e") for x in rows], "vec_id long, embedding array<double>, label int, rep string")
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embedding_dups.near_vectors(df, leaf=leaf, part=part).collect()}
    want = plain_vectors(rows)
    if leaf > 100:
        assert got == want
    else:  # a forest may part a pair in every tree
        assert set(got) == set(want) and all(got[k][0] <= want[k][0] for k in got)
        assert sum(v[0] for v in got.values()) >= 0.95 * sum(v[0] for v in want.values())
    assert embedding_dups.near_vectors(df.limit(0)).count() == 0


# --- 2: decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def test_decontamination_against_plain_windows(spark):
    rows = awkward()
    items = [(1, " ".join(rows[2][1].split()[:14])), (10, "É, é"), (2, None), (3, "..."), (4, rows[7][1].upper()), (5, "word word word"), (1, rows[3][1])]
    rows = rows + [(300, "x " + items[0][1].upper() + " y " + items[4][1], None, None, 0, "")]
    got = decontaminate.decontaminate(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    windows = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(i))
    want = []
    for d, t, *_ in rows:
        w, hit, found = plain_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted((tuple(x)[:6] for x in got.collect()), key=key) == sorted(want, key=key)
    clean = decontaminate.clean_documents(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert clean.count() == sum(not x[5] for x in want) and clean.columns == documents(spark).columns


def test_decontamination_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.decontaminate(documents(spark).limit(0), items).count() == 0
    none = decontaminate.decontaminate(documents(spark), items.limit(0)).collect()
    assert len(none) == len(awkward()) and not any(x["contaminated"] for x in none)


def test_terms_near_each_other(spark):
    docs = documents(spark, [(1, "red a b blue c red", "", "", 0, ""), (2, "blue x x x x x x red", "", "", 0, "")])
    bench = decontaminate.benchmark_terms(spark.createDataFrame([(1, "red blue")], "item_id long, text string"))
    index = decontaminate.build_index(docs, bench.select("term", "term_id").distinct())
    got = decontaminate.near_matches(index, bench, "red", "blue", 3).collect()
    assert sorted(tuple(x) for x in got) == [(1, 0, 3), (1, 5, 3)]


# --- 3: mixing

def test_mixing_reaches_targets(spark):
    r = random.Random(2)
    rows = [(i, prose(r, r.randint(0, 60)), None, r.choice(["a"] * 6 + ["b", "c", None]), 0, "") for i in range(400)] + awkward()
    got = [x.asDict() for x in mixing.mix(documents(spark, rows)).collect()]
    assert len(got) == len(rows)
    by = defaultdict(list)
    for x in got:
        by[x["source"]].append(x)
        assert 0 <= x["taken"] <= 2 * x["size"] and 0 <= x["copies"] <= 2
    total = sum(x["size"] for x in got)
    sizes = Counter()
    for d, t, _, s, *_ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, full, target = dict(zip(order, [5, 2, 1] * 9)), set(), {}
    while True:
        rest = 1.5 * total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in open_) for s in order}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for s, own in by.items():
        assert sum(x["size"] for x in own) == own[0]["source_size"] == sizes[s]
        assert own[0]["target"] == pytest.approx(target[s])
        assert sum(x["taken"] for x in own) == pytest.approx(target[s], abs=1 + sizes[s] / mixing.BLOCKS)
    again = {(x["doc_id"], x["row_hash"]): x["taken"] for x in mixing.mix(documents(spark, rows[::-1])).collect()}
    assert all(again[x["doc_id"], x["row_hash"]] == x["taken"] for x in got if rows.count(rows[3]) < 2 or x["doc_id"] != 3)
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("blocks", [7, 512])
def test_dealt_blocks_decide_what_is_taken(spark, blocks):
    r = random.Random(9)
    rows = [(i, prose(r, r.randint(0, 40)), None, r.choice(["a"] * 6 + ["b", None]), 0, "") for i in range(300)]
    whole = [x.asDict(True) for x in mixing.mix(documents(spark, rows), blocks=blocks, levels=3).collect()]
    words = defaultdict(int)
    for x in whole:
        assert x["taken"] == sum(d["words"] for d in x["draws"])
        for d in x["draws"]:
            words[x["source"], d["draw"]] += d["words"]
            assert 0 <= d["shard"] < 8
    quota = {x["source"]: round(x["target"] / x["source_size"] * blocks) for x in whole}
    for s, q in quota.items():  # every drawn block gives all of its words, no other gives any
        size = next(x["source_size"] for x in whole if x["source"] == s)
        for d in range(q + 3):
            k = d % blocks
            assert words[s, d] == ((k + 1) * size // blocks - k * size // blocks if d < q else 0)
    copies = mixing.copies_of(mixing.mix(documents(spark, rows), blocks=blocks, levels=3), blocks).collect()
    at = {x["doc_id"]: x for x in whole}
    assert Counter(c["doc_id"] for c in copies) == Counter({x["doc_id"]: x["copies"] for x in whole if x["copies"]})
    for c in copies:
        own = [d for d in at[c["doc_id"]]["draws"] if d["draw"] // blocks == c["copy"]]
        assert max(own, key=lambda d: d["words"])["words"] == next(d["words"] for d in own if d["place"] == c["place"])
        assert (c["shard"], c["place"]) in {(d["shard"], d["place"]) for d in own}


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([("a", 300), (None, 41), ("z", 0)], "source string, quota long")
    units = mixing.split_quotas(quotas, levels=3).collect()
    assert Counter(u["source"] for u in units) == {"a": 300, None: 41}
    assert len({(u["source"], u["draw"]) for u in units}) == 341
    per = Counter(u["shard"] for u in units)
    assert len(per) == 8 and max(per.values()) - min(per.values()) <= 3


def test_mixed_documents_are_repeated_whole(spark):
    rows = awkward()
    out = mixing.mixed_documents(documents(spark, rows)).collect()
    texts = {(r[0], r[1]) for r in rows}
    assert all((x["doc_id"], x["text"]) in texts for x in out)
    picks = {(x["doc_id"], x["row_hash"]): x["copies"] for x in mixing.mix(documents(spark, rows)).collect()}
    assert max(picks.values()) <= 2


# --- 4: quality

def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    held = got[got["held_out"]]
    assert len(held) > 500 and (held["predicted"] == held["quality"]).mean() > 0.98
    assert ((held["score"] >= 0.7) == (held["predicted"] == 1)).all()


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(documents(spark), labels).collect()
    assert len(got) == len(awkward()) and all(0 <= x["score"] <= 1 for x in got)
    assert quality.score_documents(documents(spark, []), labels).count() == 0
    none = quality.score_documents(documents(spark), labels.limit(0)).collect()
    assert {x["score"] for x in none} == {0.5}
    kept = quality.keep_good(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    model = quality.fit(quality.document_statistics(documents(spark)), labels)
    assert quality.load_model(quality.save_model(model)) == model


# --- 5: token counts

def plain_totals(rows, count=lambda t: len(t.split())):
    out = defaultdict(lambda: [0, 0])
    for _, t, lang, source, *_ in rows:
        out[source, lang][0] += 1
        out[source, lang][1] += count(t or "")
    return {k: tuple(v) for k, v in out.items()}


def test_token_ledger(spark, tmp_path):
    words = {"words@1": ""}
    ledger = token_counts.TokenLedger(spark, str(tmp_path / "l"), words)
    totals = lambda: {(x["source"], x["lang"]): (x["docs"], x["tokens"]) for x in ledger.totals().collect()}
    rows = awkward()
    assert totals() == {} and ledger.commit("one", documents(spark, rows)) and totals() == plain_totals(rows)
    assert not ledger.commit("one", documents(spark, rows[:4])) and totals() == plain_totals(rows)
    new = [(2, "one two three", "fr", "n", 0, ""), (900, "four", "fr", "n", 0, "")]
    gone = spark.createDataFrame([(7,), (12345,), (None,)], "doc_id long")
    broken = ledger.path + "/entries/batch=two"  # a batch that broke off before its totals
    documents(spark, rows[:9]).write.parquet(broken)
    assert ledger.commit("two", documents(spark, new), gone)
    want = plain_totals([r for r in rows if r[0] not in (2, 7)] + new)
    assert totals() == want and not ledger.commit("two", documents(spark, new), gone) and totals() == want
    ledger.commit("three", deletes=documents(spark, rows + new).select("doc_id"))
    left = plain_totals([r for r in rows if r[0] is None])
    assert totals() == left


def test_vocabulary_counts(spark, tmp_path):
    rows = awkward()[:8]
    ledger = token_counts.TokenLedger(spark, str(tmp_path / "v"), {"byte_bpe_50k@1": "byte_bpe_50k.tiktoken"})
    ledger.commit("all", documents(spark, rows))
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(token_counts.TOKENIZERS + "/byte_bpe_50k.json")
    want = plain_totals(rows, lambda t: len(whole.encode(t, add_special_tokens=False).ids))
    assert {(x["source"], x["lang"]): (x["docs"], x["tokens"]) for x in ledger.totals().collect()} == want
    assert token_counts.maintained_counts(documents(spark, []), str(tmp_path / "e")).count() == 0


def test_maintained_counts_against_plain_totals(spark, tmp_path):
    rows = awkward(n=200) + [(5000 + i, f"line {i % 9}\nmore words", "en", "web", 0, "") for i in range(80)]
    first = {}
    for d, t, *_ in rows:
        if d is not None and t is not None:
            first[t] = min(d, first.get(t, d))
    gone = {d for d, t, *_ in rows if d is not None and t is not None and first[t] < d}
    want = plain_totals([x for x in rows if x[0] not in gone])
    got = token_counts.maintained_counts(documents(spark, rows), str(tmp_path / "m")).filter("tokenizer = 'words@1'").collect()
    assert {(x["source"], x["lang"]): (x["docs"], x["tokens"]) for x in got} == want
    entries = spark.read.parquet(str(tmp_path / "m/entries/batch=revisions"))
    assert {x["source"] for x in entries.filter("docs < 0").select("source").distinct().collect()} == {"draft"} and entries.filter("docs > 0").count()


# --- 6: sharding

def test_slots_and_growth(spark, tmp_path):
    rows = awkward() + [(i, "t" * (i % 97), "", "", 0, "") for i in range(1000, 3000)]
    got = sharding.shard_documents(documents(spark, rows), str(tmp_path / "s"), shards=8, slots=512).collect()
    assert len(got) == len(rows)
    texts = Counter((r[0], 16 + len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in got) == texts
    load, places = Counter(), defaultdict(list)
    for x in got:
        load[x["shard"]] += x["size"]
        places[x["shard"]].append(x["slot"])
    assert set(load) == set(range(8)) and all(sorted(v) == list(range(len(v))) for v in places.values())
    biggest = max(x["size"] for x in got)
    assert max(load.values()) - min(load.values()) <= biggest
    one = sharding.load_map(spark, str(tmp_path / "s/map"), 1)
    totals = one.select("virtual_slot", "bytes", "rows")
    two = sharding.slot_map(totals, 9, one)
    sharding.save_map(two, str(tmp_path / "s/map"), 2)
    before, after = ({x["virtual_slot"]: x["shard"] for x in m.collect()} for m in (one, sharding.load_map(spark, str(tmp_path / "s/map"), 2)))
    held = {x["virtual_slot"]: x["bytes"] for x in one.collect()}
    moved = sum(held[s] for s in before if before[s] != after[s])
    assert set(after.values()) == set(range(9)) and moved < sum(held.values()) / 5
    with pytest.raises(Exception):
        sharding.save_map(two, str(tmp_path / "s/map"), 2)
    fewer = sharding.slot_map(totals, 5, one).collect()
    assert {x["shard"] for x in fewer} == set(range(5)) and len(fewer) == 512
    assert sharding.shard_documents(documents(spark, []), str(tmp_path / "e")).count() == 0


# --- 7: pages

ARTICLE = "<h1>A &amp; B</h1><p>First <b>bold</b> words<br>of a paragraph, long enough to be dense in this page.</p><p>Second &eacute; part\n with   more words, for it is an article."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=x>m</a></nav><article>{ARTICLE}</article><footer>f</footer></body></html>",
    f"<body><div id='nav-bar' class='menu'>m</div><div class='has-sidebar wrap'><main>{ARTICLE}</main><div class='sidebar'>s</div></div>",
    f"<body><header>Site</header><div class=post>{ARTICLE}</div><section id=comments><article class=comment><p>Nice text!</p></article></section>",
    f"<div class='cookie-notice'>We use cookies</div><article>{ARTICLE}<script>if (a<b) '</p>'</script><form><p>mail <input></form></article>",
    f"<article>{ARTICLE}</article><!-- unclosed <p>x",
    f"<ARTICLE CLASS='no-ads'>{ARTICLE}<aside>side</aside><div class='ad'>buy</div><noscript>n</noscript></ARTICLE>",
])
def test_main_text(page):
    assert main_text(page) == "A & B\n\nFirst bold words of a paragraph, long enough to be dense in this page.\n\nSecond é part with more words, for it is an article."


@pytest.mark.parametrize("page", [
    f"<body><nav><a href=x>m</a></nav><article><div class='elementor-widget elementor-widget-text-editor'>{ARTICLE}</div><div class='social'>s</div></article>",
    f"<body><ul class=menu><li>m</ul><div class='market-share'>{ARTICLE}</div><div class='share'>buy</div>",
    f"<body><div class='nav'>m</div><article class='social-science'>{ARTICLE}<div class='ad'>buy</div></article>",
    f"<body><article><div class='post widget'><div class='all-related-work'>{ARTICLE}</div></div></article><div class=ad>buy {'more ' * 60}</div>",
    f"<body><form action=x><input><div class='navbar'>m</div><div>{ARTICLE}</div></form>",
    f"<body><form role=form><div class='post'>{ARTICLE}</div></form><div class=comments><article class=comment>Nice</article></div>",
    f"<body><article><img alt=\"12\" screen\">{ARTICLE}<p class=\"ad\">buy</p></article>",
    f"<body><article><p title='it's'></p>{ARTICLE}<p data-class='x' class='ad' title='a > b'>buy</p></article>",
    f"<body><article><p title=\"class='ad' > \"></p><div data-id=share>{ARTICLE}</div></article>",
])
def test_main_text_of_other_page_forms(page):
    test_main_text(page)


def paragraph(k, n=20):
    return " ".join(f"This is sentence {k * 100 + i} of the article with some words." for i in range(n))


P = [f"<p>{paragraph(k)}</p>" for k in range(5)]


@pytest.mark.parametrize("page,kept", [
    (f"<body><article>{P[1]}<section class='related-work'>{P[2]}</section>{P[3]}</article></body>", (1, 2, 3)),
    (f"<body><article>{P[1]}<div class='market-share'>{P[2]}</div>{P[3]}</article></body>", (1, 2, 3)),
    (f"<body><div class=content>{P[1]}<div id='social-science'>{P[2]}</div>{P[3]}</div></body>", (1, 2, 3)),
    ("<body>" + "".join(f"<div class='elementor-widget'>{p}</div>" for p in P) + "</body>", range(5)),
    ("<body><div class=wrap>" + "".join(f"<div class='elementor-widget'>{p}</div>" for p in P) + "</div></body>", range(5)),
    ("<body><article>" + "".join(f"<div class='widget'>{p}</div>" for p in P[:3]) + "</article></body>", range(3)),
    (f"<body><article>{P[1]}<div class='related'><a href=a>One other story here</a> <a href=b>Two other stories</a></div>{P[2]}"
     "<div class=social><a href=x>Share this on the network</a></div></article></body>", (1, 2)),
    (f"<body><article>{P[1]}<div class='sidebar'>{P[2]}</div>{P[3]}<div class='ad'>{P[4][:90]}</p></div></article></body>", (1, 3)),
    (f"<body><article>{P[1]}</article><div class='promo'>{P[2]}</div><div class='comments'>{P[3]}</div></body>", (1,)),
])
def test_names_cut_no_article_text(page, kept):
    assert main_text(page) == "\n\n".join(paragraph(k) for k in kept)


def test_headings_stay_whatever_their_class():
    assert main_text(f"<body><article><h2 class='notice'>Notice of meeting</h2>{P[1]}</article></body>") == "Notice of meeting\n\n" + paragraph(1)


def test_generated_pages_with_known_articles():
    r = random.Random(17)
    names = ["widget", "related-work", "market-share", "social", "promo-text", "notice", "overlay", "banner", "elementor-widget", "share", "intro", "body"]
    furniture = ["<nav><ul><li><a href=a>Home page</a></li><li><a href=b>All news</a></li></ul></nav>", "<aside><p>See also this</p></aside>",
                 "<div class='ad'>Buy this thing now for less.</div>", "<footer>All rights of the site</footer>", "<div class='menu'><a href=c>Top</a></div>"]
    for _ in range(200):
        parts = [paragraph(r.randrange(900), r.randint(3, 12)) for _ in range(r.randint(2, 6))]
        wrapped = [f"<{t} class='{r.choice(names)}'><p>{p}</p></{t}>" if r.random() < 0.5 else f"<p>{p}</p>" for p in parts for t in [r.choice(["div", "section"])]]
        inner = "".join(w + (r.choice(furniture[1:3]) if r.random() < 0.2 else "") for w in wrapped)
        page = "<body>" + "".join(r.sample(furniture, 2)) + f"<article>{inner}</article>" + r.choice(furniture) + "</body>"
        assert main_text(page) == "\n\n".join(parts)


def test_pages(spark):
    deep = "<div>" * 5000 + "deep text of some length" + "</div>" * 5000
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain words"), (4, "u", "<p>a<p>b"), (5, "u", deep), (6, "u", "<p title=\"a"), (6, "u", "<p title=\"a"), (7, "u", "<script>x")]
    df = spark.createDataFrame([(*x, 9) for x in rows], "page_id long, url string, html string, n_chars long")
    got = sorted((x["page_id"], x["text"], x["n_chars"]) for x in extract_pages(df).collect())
    want = [(1, ""), (2, ""), (3, "plain words"), (4, "a\n\nb"), (5, "deep text of some length"), (6, ""), (6, ""), (7, "")]
    assert got == [(i, t, len(t)) for i, t in want] and extract_pages(df.limit(0)).count() == 0


# --- 8: lines

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    r = random.Random(4)
    for k in range(1500):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(0, 60))).encode() for _ in range(2))
        if k % 3:
            b = bytearray(a)
            for _ in range(r.randint(0, 8)):
                at = r.randrange(len(b) + 1)
                b[at:at + r.randint(0, 1)] = r.choice([b"", b"a", b"x"])
            b = bytes(b)
        true, most = plain_distance(a, b), r.randint(0, 60)
        got = fuzzy_lines.edit_distance(a, b, most)
        assert got == true if true <= most else got > most


@pytest.mark.parametrize("part", [2000, 3])
def test_lines_against_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(fuzzy_lines, "PART", part)
    r = random.Random(8)
    lines = [prose(r, 40) for _ in range(12)]
    close = [x.split(" ") for x in lines[:6]]
    for c in close:
        c[r.randrange(len(c))] += "s"
    pool = lines + [" ".join(c) for c in close] + [lines[0].upper() + "!", "on 12 of 5", "on 99 of 1", "--", ""]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(6)), "", "", 0, "") for i in range(40)] + [(90, None, "", "", 0, ""), (91, "", "", "", 0, "")]
    rows.append(rows[4])
    plain = {x: b" ".join(fuzzy_lines.normalise(x).split()) for x in pool}
    known = sorted({p for p in plain.values() if p})
    sims = {p: int(fuzzy_lines._majority(np.array([xxhash.xxh64_intdigest(w, 3) for w in p.split()], dtype=np.uint64), np.array([0]))[0]) for p in known}
    number = {p: i for i, p in enumerate(known)}
    links = [(number[a], number[b]) for a in known for b in known if a < b and (sims[a] ^ sims[b]).bit_count() <= fuzzy_lines.BITS
             and plain_distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9)]
    group = groups_of(range(len(known)), links)
    seen, want = {}, {}
    for d, t, *_ in sorted(rows, key=lambda x: x[0]):
        kept = []
        for k, line in enumerate((t or "").split("\n")):
            g = group[number[plain[line]]] if plain.get(line) else None
            if g is None or seen.setdefault(g, (d, k)) == (d, k):
                kept.append(line)
        want[d] = None if t is None else "\n".join(kept)
    got = fuzzy_lines.dedup_lines(documents(spark, rows))
    out = got.collect()
    assert len(out) == len(rows) and {x["doc_id"]: x["text"] for x in out} == want and links
    assert all(x["n_lines"] - x["n_removed"] == (0 if x["text"] is None else len(x["text"].split("\n")) if x["n_removed"] < x["n_lines"] else 0) for x in out)
    assert got.columns == [*documents(spark).columns, "n_lines", "n_removed"]


def test_short_lines_by_edits_alone(spark):
    r = random.Random(18)
    pool = []
    for n in [2, 3, 5, 5, 6, 7, 8, 9, 10, 10, 11, 12, 13, 14, 15, 16, 17, 18, 20, 20] * 2:
        line = prose(r, n)
        pool.append(line)
        for changes in (1, 1, max(1, len(line) // 10), max(1, len(line) // 20)):
            c = list(line)
            for at in r.sample(range(len(c)), changes):
                c[at] = r.choice(["", "q", c[at] + "x"])
            pool.append("".join(c))
    pool = [p for p in dict.fromkeys(pool) if p]
    plain = [b" ".join(fuzzy_lines.normalise(x).split()) for x in pool]
    known = sorted(set(plain))
    number = {p: i for i, p in enumerate(known)}
    links = [(number[a], number[b]) for a in known for b in known if a < b and len(b) <= len(a) / 0.9 + 1 and len(a) <= len(b) / 0.9 + 1
             and plain_distance(a, b) <= max(len(a), len(b)) // 10]
    group = groups_of(range(len(known)), links)
    r.shuffle(pool)
    rows = [(None if i == 3 else i, x, "", "", 0, "") for i, x in enumerate(pool)]
    seen, want = set(), Counter()
    for d, t, *_ in sorted(rows, key=lambda x: -1 if x[0] is None else x[0]):
        g = group[number[b" ".join(fuzzy_lines.normalise(t).split())]]
        want[d, "" if g in seen else t] += 1
        seen.add(g)
    assert Counter((x["doc_id"], x["text"]) for x in fuzzy_lines.dedup_lines(documents(spark, rows)).collect()) == want and len(links) > 60


def test_awkward_lines(spark):
    assert fuzzy_lines.dedup_lines(documents(spark)).count() == len(awkward())
    assert fuzzy_lines.dedup_lines(documents(spark, [])).count() == 0


# --- 9: repeated strings

def plain_repeats(rows):
    first = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49) if d is not None else ():
            first[b[i:i + 50]] = min(first.get(b[i:i + 50], d), d)
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("block", [2 << 20, 900])
def test_repeats_against_all_strings(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 8000)
    r = random.Random(6)
    passage = prose(r, 30)
    rows = awkward() + [(400 + i, prose(r, r.randint(0, 20)) + passage[r.randint(0, 60):] + prose(r, 10), "", "", 0, "") for i in range(25)]
    rows += [(500, "ab" * 400, "", "", 0, ""), (501, "ba" * 90, "", "", 0, ""), (502, "é" * 200, "", "", 0, ""), (499, "xé" + "é" * 60, "", "", 0, "")]
    key = lambda x: tuple(str(v) for v in x)
    got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    assert sorted((tuple(x)[:5] for x in got), key=key) == sorted(plain_repeats(rows), key=key)
    assert all(hashlib.sha256(x["kept"]).hexdigest() == x["kept_sha256"] for x in got)
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def test_one_string_in_many_surroundings_is_not_built():
    r = random.Random(31)
    stem = b"https://example/path"
    segments = [bytes(r.choice(b"abcdefgh") for _ in range(30)) + stem + bytes(r.choice(b"abcdefgh") for _ in range(30)) for _ in range(20_000)]
    segments += [segments[5][2:72] for _ in range(3)]
    windows = np.array([len(s) - 49 for s in segments])
    runs = suffix_dedup._shared_runs(b"".join(segments), windows)
    assert runs[:, 1].sum() < 200  # of some 600,000
    first = np.cumsum(windows) - windows
    assert {tuple(x) for x in runs.tolist()} == {(first[5] + 2, 21), *[(f, 21) for f in first[-3:]]}


# --- 10: SimHash

def plain_print(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    shingles = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("limit", [20_000, 2])
def test_simhash_against_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", limit)
    r = random.Random(9)
    rows = awkward()
    for k in range(6):
        ws = prose(r, 300).split(" ")
        for i in range(8):
            own = list(ws)
            own[r.randrange(300)] = f"new{i}"
            rows.append((1000 + 10 * k + i, " ".join(own), "", "", 0, ""))
    prints = [(d, plain_print(t)) for d, t, *_ in rows]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i][1] ^ prints[j][1]).bit_count() <= 4]
    group = groups_of(range(len(prints)), links)
    least = {}
    for i, g in group.items():
        if prints[i][0] is not None:
            least[g] = min(least.get(g, prints[i][0]), prints[i][0])
    want = sorted((str(d), f"{p:016x}", least.get(group[i])) for i, (d, p) in enumerate(prints))
    near = simhash.near_duplicates(documents(spark, rows))
    assert sorted((str(x["doc_id"]), x["fingerprint"], x["component_id"]) for x in near.collect()) == want
    kept = simhash.drop_near_duplicates(documents(spark, rows)).collect()
    assert sorted(str(x["doc_id"]) for x in kept) == sorted({str(v) for v in least.values()})
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_random_fingerprints_at_every_distance(spark):
    r = random.Random(12)
    prints = [r.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        q = p
        for b in r.sample(range(64), r.randint(1, 6)):
            q ^= 1 << b
        prints.append(q)
    prints = sorted(set(prints))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(p), i) for i, p in enumerate(prints)], "fp long, rep long")
    links = [(x["a"], x["b"]) for x in simhash.links(df).collect()]
    true = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert groups_of(range(len(prints)), links) == groups_of(range(len(prints)), true)


# --- extra columns that clash, and empty tables, for the forms that keep documents whole

OWN_NAMES = ["removed", "n_lines", "n_removed", "shard", "virtual_slot", "_doc", "_row", "_copies", "_hash", "_again", "row", "copies", "score", "doc_key", "row_key", "fp", "rep", "size"]


def with_own_names(spark, rows):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in OWN_NAMES)
    return spark.createDataFrame([(*r[:4], *[f"{n}!" for n in OWN_NAMES]) for r in rows], schema).repartition(3)


@pytest.mark.parametrize("name", ["quality", "near", "clean", "mixed", "sharded", "lines"])
def test_columns_of_any_name_are_kept(spark, tmp_path, name):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, " ".join(awkward()[2][1].split()[:14]))], "item_id long, text string")
    run = {
        "quality": lambda d, p: quality.keep_good(d, labels), "near": lambda d, p: simhash.drop_near_duplicates(d),
        "clean": lambda d, p: decontaminate.clean_documents(d, items), "mixed": lambda d, p: mixing.mixed_documents(d),
        "sharded": lambda d, p: sharding.sharded_documents(d, p), "lines": lambda d, p: fuzzy_lines.dedup_lines(d)}[name]
    own = {"sharded": {"shard", "virtual_slot"}, "lines": {"n_lines", "n_removed"}}.get(name, set())
    docs = with_own_names(spark, awkward())
    got = run(docs, str(tmp_path / "a"))
    assert got.columns == docs.columns
    rows, plain = got.collect(), run(documents(spark), str(tmp_path / "b")).collect()
    assert Counter((x["doc_id"], x["text"]) for x in rows) == Counter((x["doc_id"], x["text"]) for x in plain)
    assert all(x[n] == f"{n}!" for x in rows for n in OWN_NAMES if n not in own) and len(rows) > 5
    assert all(x[n] != f"{n}!" for x in rows for n in own)
    assert run(docs.limit(0), str(tmp_path / "c")).count() == 0
