from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import decontaminate, html_text, language_model, mixing, pii

# --- personal data ---


def brute_base(text: str):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for k, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            if least <= len(digits) <= most and (k == 3 or luhn):
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab@@..++0123456789  -()xé") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute_base(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail me: john dot doe at example dot com now", "email", "john dot doe at example dot com"),
        ("x j.doe [at] example.com y", "email", "j.doe [at] example.com"),
        ("x bob(at)mail(dot)example(dot)org y", "email", "bob(at)mail(dot)example(dot)org"),
        ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("write to jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
        ("a​b@ex​ample.com", "email", "a​b@ex​ample.com"),
        ("call +four nine 170 123 4567 now", "phone", "+four nine 170 123 4567"),
        ("card four one one one 1111 1111 1111.", "card", "four one one one 1111 1111 1111"),
        ("host 10[.]0[.]0[.]1 is up", "ip", "10[.]0[.]0[.]1"),
    ],
)
def test_disguised_spans_map_back(text, kind, found):
    spans = [(pii.KINDS[k], text[a:b]) for a, b, k in pii.all_spans(text)]
    assert spans == [(kind, found)]
    assert pii.redact(text) == text.replace(found, f"<{kind.upper()}>")


def test_pretest_lets_every_disguise_through(monkeypatch):
    gaps = ("", " ", "  ", "\t", "\n", "\u00a0")
    brackets = ("[]", "()", "{}", "<>")
    ats = [f"{o}{b[0]}{i}{w}{i}{b[1]}{o}" for b in brackets for w in ("at", "AT", "arroba", "arobase", "@") for i in gaps for o in ("", " ")]
    ats += [f"{g}{w}{g}" for w in ("at", "arroba", "Arobase", "@") for g in gaps[1:]] + ["@ ", " @", "@"]
    dots = [f"{b[0]}{i}{w}{i}{b[1]}" for b in brackets for w in ("dot", "punkt", "PUNTO", "point", ".", "pun\u212at") for i in gaps]
    dots += [f"{g}{w}{g}" for w in ("dot", "punkt", "punto", "point", ".") for g in gaps[1:]] + ["."]
    texts = [f"write john.doe{at}example{dot}com soon" for at in ats for dot in dots]
    texts += [f"host 192{dot}168{dot}10{dot}20 up" for dot in dots]
    texts += [f"call {plus}{gap}49 30 1234567" for plus in ("plus", "Plus", "más", "plu\u017f") for gap in gaps] + ["call plus (49) 30 1234567"]
    texts += [f"{o}{w} nine 170 123 4567{o}" for o in ('"', "/", ":", "'", "+", "+ ") for w in ("four", "vier", "FOUR", "f\u0130ve", "\u017fix", "fünf")]
    texts += ["card:four one one one 1111 1111 1111;", "tel:+four nine,one-seven zero 123 4567!"]
    gated = [pii.all_spans(t) for t in texts]
    monkeypatch.setattr(pii, "_disguised", lambda text: True)
    assert gated == [pii.all_spans(t) for t in texts]
    for text, kind in [
        ("call plus 49 30 1234567", "phone"),
        ("john.doe@example . com", "email"),
        ("john at example . com", "email"),
        ("192 . 168 . 10 . 20", "ip"),
        ("john[  at  ]example.com", "email"),
        ('"+four nine 170 123 4567"', "phone"),
    ]:
        monkeypatch.undo()
        assert [pii.KINDS[k] for _, _, k in pii.all_spans(text)] == [kind], text


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("ab@cd [dot] e [dot] com", "ab@cd [dot] e [dot] com"),
        ("x@a [dot] b [dot] com", "x@a [dot] b [dot] com"),
        ("n" * 70 + " (at) mail (dot) org!", "n" * 70 + " (at) mail (dot) org"),
        # A base span stays, and spans that overlap one are not added.
        ("to john.doe@a.b.c.d.e.f [dot] com now", "john.doe@a.b.c.d.e.f"),
        ("to john.doe@a [dot] b.c.d.e.f.g.h [dot] com now", "john.doe@a [dot] b.c.d.e.f.g.h [dot] com"),
        ("a [dot] b [dot] c [dot] d [dot] e [dot] f (at) " + "l" * 80 + " [dot] " + "m" * 80, None),
        ("x (at) a [dot] bc y (at) d [dot] ef", "x (at) a [dot] bc"),
    ],
)
def test_labels_have_no_limit(text, found):
    spans = [text[a:b] for a, b, k in pii.all_spans(text) if pii.KINDS[k] == "email"]
    assert spans[:1] == [text if found is None else found]
    assert len(spans) == text.count("(at)") + text.count("@")


def test_many_signs_take_linear_time():
    text = "a dot " * 40_000 + "a at " * 40_000 + "@ . " * 20_000
    began = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - began < 20


def test_plain_text_has_no_disguised_spans():
    for text in ("look at example.com today. at that. dot", "one of them, two of us", "at and by at the dot", "a < b (c) [d] . e"):
        assert pii.all_spans(text) == []


def test_rewriting_keeps_source_ranges():
    state = pii.Rewritten("aXXbYc")
    state.replace([(1, 3, "pqr"), (4, 5, "")])
    assert state.text == "apqrbc"
    assert [state.to_source(i, i + 1) for i in range(6)] == [(0, 1), (1, 3), (1, 3), (1, 3), (3, 4), (5, 6)]
    state.replace([(0, 2, "-")])
    assert state.text == "-qrbc"
    assert [state.to_source(i, i + 1) for i in range(5)] == [(0, 3), (1, 3), (1, 3), (3, 4), (5, 6)]


def test_personal_data_rows(make_documents, odd_rows):
    rows = odd_rows + [(20, "a@b.co +1 (017) 555-7713"), (20, None)]
    got = pii.find_personal_data(make_documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 20 and r.n_email:
            assert (r.n_phone, r.spans) == (1, "email:0:6,phone:7:24")
            assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        else:
            assert (r.spans, r.base_sha256) == ("", hashlib.sha256(b"").hexdigest())
    assert pii.find_personal_data(make_documents([])).collect() == []


# --- pages ---


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <b>c<div>d</div>e", "a\n\nb c\n\nd\n\ne"),
        ("<article><p>x<!-- y", "x"),
        ("<script>if(a<b)</script>t<style>x", "t"),
        ("a < b > c <3 &lt;p&gt;", "a < b > c <3 <p>"),
        ("<body><nav>n</nav><main><h1>T</h1><p>a&nbsp;&amp; b<br>c</p><div class='comments'>no</div><ul><li>1<li>2</ul></main><footer>f", "T\n\na & b c\n\n1\n\n2"),
        ("<article><header><h1>T</h1></header><p>t</p><aside>no</aside><form>no</form></article><article class=comment><p>much longer text of a comment</p></article>", "T\n\nt"),
        ("<article><div class='cookie-notice'>no</div><p>yes</p><div class=AdBox>no</div></article>", "yes"),
        ("<div class='content no-sidebar'><h1>T</h1><p>The whole story.</p></div>", "T\n\nThe whole story."),
        ("<div class='layout has-sidebar'><article><p>Story</p></article><div class=sidebar>no</div></div>", "Story"),
        ("<form id='aspnetForm'><h1>T</h1><p>The whole story.</p><form>no</form></form>", "T\n\nThe whole story."),
        ("<form><div role=main><p>Story</p></div><input><p>Send</p></form>", "Story"),
        ("<main><article><h2>One</h2><p>a</p></article><article><h2>Two</h2><p>b and more</p></article></main>", "One\n\na\n\nTwo\n\nb and more"),
        ("<article><section id='related-work'><p>Others did.</p></section><div class='discussion'><p>We did.</p></div></article>", "Others did.\n\nWe did."),
        ("<article><p>t</p><article class='comment'><p>reader</p></article><div id=comments><article class=comment>x</article></div></article>", "t"),
        ("<div class='page-footer'>f</div><div class='left-sidebar'>s</div><p>The story of the page is long enough.</p>", "The story of the page is long enough."),
        ("<div class='main-with-sidebar'><p>x</p></div><p>longer text than that of the other</p>", "x\n\nlonger text than that of the other"),
        ("<aside><article><p>no</p></article></aside><article><p>yes</p></article>", "yes"),
        ("<b>" * 20_000 + "<p>a</p>" * 300 + "</i>" * 20_000 + "<li>" * 300, "\n\n".join("a" * 300)),
        ("<div>" * 20_000 + "deep", "deep"),
    ],
)
def test_page_text(source, text):
    assert html_text.main_text(html_text.parse(source or ""), set()) == text


@pytest.mark.parametrize("most_broadcast", [1_000_000, 0])
def test_templates_go_and_articles_stay(spark, most_broadcast):
    shell = "<body><div class=top>Site name</div><div id=x><p>Text {i} of its own</p><p>same words</p></div><section>Read this too</section>"
    rows = [(i, f"https://Host.example/{i}", shell.replace("{i}", str(i))) for i in range(9)]
    rows += [(20, "https://other.example/", shell.replace("{i}", "20")), (21, None, None), (22, "odd", ""), (0, "https://Host.example/0", rows[0][2])]
    rows += [(30 + i, "http://a.example", f"<article><p>often quoted</p><p>own {i}</p></article>") for i in range(9)]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in html_text.extract(pages, most_broadcast=most_broadcast).collect()), key=str)
    expected = [(i, u, f"Text {i} of its own") for i, u, _ in rows[:9]] + [(0, rows[0][1], "Text 0 of its own")]
    expected += [(20, "https://other.example/", "Site name\n\nText 20 of its own\n\nsame words\n\nRead this too"), (21, None, ""), (22, "odd", "")]
    expected += [(30 + i, "http://a.example", f"often quoted\n\nown {i}") for i in range(9)]
    assert got == sorted(((*e, len(e[2])) for e in expected), key=str)
    assert html_text.extract(pages.limit(0), most_broadcast=most_broadcast).collect() == []


@pytest.mark.parametrize("most_broadcast", [1_000_000, 0])
def test_short_elements_and_copies_are_no_templates(spark, most_broadcast):
    page = "<body><div>Shop of Ann</div><p>{0} it is <b>{1}</b> so.</p><h2>Introduction</h2><ul><li>Yes</li><li>{0}</li></ul>{2}</body>"
    some = "<section>Read the guide</section>"
    rows = [(i, page.format(f"own{i}", "not" if i % 2 else "now", some if i < 10 else "")) for i in range(60)]
    texts = {i: f"own{i} it is {'not' if i % 2 else 'now'} so.\n\nIntroduction\n\nYes\n\nown{i}" + ("\n\nRead the guide" if i < 10 else "") for i in range(60)}
    copied = "<body><p>first part of it</p><p>second part</p><div>third part</div></body>"
    made = [(i, f"https://large.example/{i}", h) for i, h in rows] + [(100 + i, f"https://copy.example/{i}", f"<head><title>{i}</title></head>{copied}") for i in range(12)]
    pages = spark.createDataFrame(made, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, most_broadcast=most_broadcast).collect()}
    assert got == texts | {100 + i: "first part of it\n\nsecond part\n\nthird part" for i in range(12)}


def test_very_long_pages(spark):
    words = " ".join(f"word{i}" for i in range(700_000))
    pages = spark.createDataFrame([(i, f"https://h{i}.example", f"<nav>n</nav><p>{words}</p><footer>f") for i in range(3)], "page_id long, url string, html string")
    got = html_text.extract(pages).select("page_id", "n_chars", F.xxhash64("text").alias("h")).collect()
    assert {r.n_chars for r in got} == {len(words)} and len({r.h for r in got}) == 1 and len(got) == 3


# --- benchmark ---


def test_one_lower_case_for_items_and_documents(spark, make_documents):
    item = "ΛΟΓΟΣ ΝΟΜΟΣ ΚΟΣΜΟΣ İSTANBUL ΤΟΠΟΣ ΧΡΟΝΟΣ ΠΟΝΟΣ. ΤΕΛΟΣ ΛΟΓΟΣ ΝΟΜΟΣ ΑΡΧΗΣ ΜΕΣΟΣ."
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    documents = make_documents([(1, item), (2, f"before it {item} after it"), (3, item.replace("Σ", "σ")), (4, "something else altogether")])
    assert sorted(r.doc_id for r in decontaminate.leaks(documents, benchmark).collect()) == [1, 2, 3]




def test_block_max_wand_equals_brute_force():
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary[: rng.choice([40, 300])]) for _ in range(rng.randrange(1, 60)))) for i in range(200)]
    index = decontaminate.Index.build(items + [(900, ""), (901, None)])
    hits = 0
    for _ in range(300):
        query = sorted(rng.sample(range(len(index.terms)), rng.randrange(1, min(90, len(index.terms)))))
        scores: dict[int, float] = {}
        for t in query:
            for n, v in zip(index.postings[t], index.impacts[t]):
                scores[n] = scores.get(n, 0) + v
        expected = sorted(n for n, v in scores.items() if v >= 1)
        assert sorted(n for n, _ in index.retrieve(query)) == expected
        hits += len(expected)
    assert hits > 300


@pytest.mark.parametrize("shard_items", [10_000, 7])
def test_leaks_equal_containment(spark, make_documents, odd_rows, shard_items):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(400)]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{sentence(rng.randrange(8, 50))}. {sentence(6)}.") for i in range(30)]
    rows = [(100 + i, f"{sentence(rng.randrange(300))} {items[i][1].upper() if i % 2 else items[i][1]} {sentence(rng.randrange(300))}") for i in range(30)]
    rows += [(200 + i, sentence(500)) for i in range(20)] + [(300, " ".join(items[3][1].split()[:4])), (301, items[5][1]), (301, items[5][1])]
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (92, "!!")], "item_id long, text string")
    documents = make_documents(rows + odd_rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, benchmark, shard_items=shard_items).collect()}
    assert got == {(100 + i, i) for i in range(30)} | {(301, 5)}
    kept = decontaminate.clean_documents(documents, benchmark, shard_items=shard_items)
    assert kept.columns == documents.columns
    assert kept.count() == 20 + 1 + len(odd_rows)
    assert decontaminate.leaks(documents, benchmark.limit(0)).collect() == []


# --- mixing ---


def brute_targets(sizes: dict, share=1.5, weights=(3, 1, 2), epochs=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > epochs * sizes[s] or sizes[s] == 0}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("block", [16, 256])
def test_mix_hits_its_targets(make_documents, odd_rows, block):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(400), rng.choice("aaaaabcdeé")) for i in range(300)] + [(900, "x y", None), (901, "", "empty"), (902, None, None)]
    rows += odd_rows
    documents = make_documents(rows)
    mixed = mixing.mix(documents, block=block).collect()
    assert len(mixed) == len(rows)
    sizes: dict = {}
    for r in rows:
        source = r[2] if len(r) > 2 else "s"
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    expected, taken = brute_targets(sizes), {}
    for r in mixed:
        assert r.source_size == sizes[r.source]
        assert np.isclose(r.target, expected[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    again = mixing.mix(documents.repartition(5), block=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_schedule_is_even_at_every_point(make_documents):
    rows = [(i, "w " * 500, s) for i, s in enumerate("aaabbcaab" * 10)]
    targets = mixing.source_targets(make_documents(rows).selectExpr("source", "500L size"))
    slots = sorted(mixing.schedule(targets, 64).collect(), key=lambda r: r.slot)
    counts, need = {}, {}
    for r in slots:
        need[r.source_no] = need.get(r.source_no, 0) + 1
    for k, r in enumerate(slots, 1):
        assert r.rank == counts.get(r.source_no, 0)
        counts[r.source_no] = r.rank + 1
        assert all(abs(counts.get(s, 0) - k * n / len(slots)) < 4 for s, n in need.items())


def test_mix_of_nothing(make_documents):
    assert mixing.mix(make_documents([])).collect() == []
    assert mixing.mix_documents(make_documents([(1, None), (2, "")])).collect() == []


# --- language model ---


def test_gradients_equal_differences():
    network = language_model.Network.fresh()
    rng = np.random.default_rng(1)
    contexts, targets = rng.integers(0, language_model.SIZE + 1, (4, 60)), rng.integers(0, language_model.SIZE, 60)
    for name in language_model._NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))
    _, dense, inputs = network.gradients(contexts, targets)
    assert np.isclose(sum(np.exp(network.log_probabilities(contexts[:, [0] * language_model.SIZE], np.arange(language_model.SIZE)))), 1, atol=1e-4)

    def slope(array, at):
        array[at] += 1e-5
        up = -network.log_probabilities(contexts, targets).mean()
        array[at] -= 2e-5
        down = -network.log_probabilities(contexts, targets).mean()
        array[at] += 1e-5
        return (up - down) / 2e-5

    assert np.isclose(slope(network.class_weights, (3, 5)), dense["class_weights"][3, 5], atol=1e-6)
    assert np.isclose(slope(network.class_bias, (7,)), dense["class_bias"][7], atol=1e-6)
    word = inputs[2][0][5]
    assert np.isclose(slope(network.inputs, (2, word, 4)), inputs[2][1][5][4], atol=2e-4)


def test_context_stays_inside_its_text():
    got = language_model.contexts_of(np.array([5, 6, 7, 8], np.int16), np.array([0, 3, 3, 4]))
    pad = language_model._PADDING
    assert got.T.tolist() == [[pad, pad, 6, 7], [pad, 5, 7, pad], [5, 6, pad, pad], [pad, pad, pad, pad]]


def test_scores_equal_single_predictions_and_learn_order(spark, make_documents, odd_rows):
    rng = random.Random(3)
    rows = [(i, " ".join(f"a{k} b{k} c{k}" for k in [rng.randrange(20) for _ in range(40)])) for i in range(300)]
    shuffled = rows[0][1].split()
    rng.shuffle(shuffled)
    documents = make_documents(rows + [(9_000, " ".join(shuffled)), (9_001, rows[1][1]), *[(i and i + 20_000, t) for i, t in odd_rows]])
    vocabulary, network = language_model.fit(documents)
    got = {}
    for r in language_model.score(documents, vocabulary, network).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert np.isclose(got[1][0].log_probability, got[9_001][0].log_probability, rtol=1e-5)
    assert got[0][0].mean > got[9_000][0].mean + 0.5
    empty = [r for r in language_model.score(make_documents([(1, None), (2, ""), (3, " ")]), vocabulary, network).collect()]
    assert all((r.n_words, r.log_probability, r.mean) == (0, 0.0, None) for r in empty)
    # Word by word, without batches.
    import pyarrow as pa

    _, _, words, numbers, contexts = next(language_model._encoded(pa.array([rows[7][1]]), vocabulary))
    single = sum(float(network.log_probabilities(contexts[:, [k]].astype(int), numbers[[k]].astype(int))[0]) for k in range(len(numbers)))
    assert np.isclose(single, got[7][0].log_probability, rtol=1e-4)


def test_splits_of_the_table_do_not_change_the_scores(spark, make_documents, monkeypatch):
    monkeypatch.setattr(language_model, "_PART_WORDS", 500)
    rng = random.Random(6)
    documents = make_documents([(i, " ".join(f"v{rng.randrange(90)}" for _ in range(40))) for i in range(200)] + [(900, "same row"), (900, "same row")])
    found = []
    for n in (2, 8):
        dealt = documents.repartition(n)
        model = language_model.fit(dealt)
        found.append({r.doc_id: r.log_probability for r in language_model.score(dealt, *model).collect()})
    assert found[0] == pytest.approx(found[1], rel=1e-4)


def test_tables_grow_with_the_corpus():
    assert [language_model.table_size(n) for n in (0, 10**6, 10**8, 10**12)] == [1024, 1024, 10_000, 1_000_000]
    vocabulary = language_model.Vocabulary(np.empty(0, np.uint64), np.empty(0, np.int32), 10_000, 312)
    network = language_model.Network.from_flat(language_model.Network.fresh(10_000).flat(), 10_000)
    numbers = vocabulary.encode(np.arange(5000, dtype=np.uint64))
    assert numbers.max() == 311
    contexts = language_model.contexts_of(numbers, np.array([0, 5000]), vocabulary.size).astype(int)
    every = network.log_probabilities(contexts[:, [0] * 10_000], np.arange(10_000))
    assert np.isclose(np.exp(every).sum(), 1, atol=1e-3)


def test_words_that_share_a_number_have_their_own_probability(make_documents):
    frequent = {f"often{i}": 9 for i in range(language_model.SIZE - language_model.SHARED)}
    rare = {f"rare{i}": 1 + i % 4 for i in range(400)}
    rows = [(i, w) for i, (w, n) in enumerate((frequent | rare).items()) for _ in range(n)]
    documents = make_documents(rows)
    vocabulary, network = language_model.fit(documents)
    scores: dict[str, set] = {}
    for r in language_model.score(documents, vocabulary, network).collect():
        scores.setdefault(list(frequent | rare)[r.doc_id], set()).add(r.log_probability)
    assert all(max(s) - min(s) < 1e-3 for s in scores.values())
    assert np.isclose(sum(np.exp(min(s)) for s in scores.values()), 1, atol=1e-2)
    import pyarrow as pa

    _, _, _, numbers, _ = next(language_model._encoded(pa.array([" ".join(rare)]), vocabulary))
    by_number: dict[int, list] = {}
    for word, number in zip(rare, numbers.tolist()):
        by_number.setdefault(number, []).append(min(scores[word]) - np.log(rare[word]))
    assert max(by_number) < language_model.SHARED
    assert all(np.allclose(own, own[0], atol=2e-3) for own in by_number.values())


def test_language_model_of_nothing(make_documents):
    none = make_documents([])
    assert language_model.score(none, *language_model.fit(none)).collect() == []
