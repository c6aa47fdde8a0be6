import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkhunt.llm import chat_format, html_templates, mixing, pu_toxicity
from tests.llm.helpers import docs_table


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 5, "c": 100, None: 7}, {"x": 3}, {"a": 1000, "b": 1, "c": 1, "d": 1, "e": 2}, {"a": 0, "b": 9}])
def test_targets_are_shared_again(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_the_tree_deals_out_every_block_once():
    quotas = np.array([500, 3, 0, 77])
    held = [mixing.split_quotas(quotas, s, 7, 1) for s in range(7)]
    assert (sum(h for _, h in held) == quotas).all()
    assert all((held[i][0] + held[i][1] == held[i + 1][0]).all() for i in range(6))
    assert max(h.sum() for _, h in held) - min(h.sum() for _, h in held) <= 7


def test_the_mix_comes_near_its_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 60)), "ab"[i % 7 == 0] if i % 5 else None) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", None), (5, rows[5][1], rows[5][2]), (None, "null id here", "b"), (2000, "v " * 3000, "a")]
    docs = docs_table(spark, rows).withColumnsRenamed({"row": "mix", "a.b": "block"})
    out = mixing.mix(docs, block_words=200, shard_words=1500)
    assert out.columns == [*docs.columns, "_mix"]
    got = out.collect()
    assert len(got) == len(rows)
    size, target, taken = {}, {}, Counter()
    for r in got:
        m = r["_mix"]
        assert len(m.draws) <= 3 and m.size == len((r.text or "").split())
        size[r.source], target[r.source] = m.source_size, m.target
        taken[r.source] += m.size * len(m.draws)
    assert target == pytest.approx(brute_targets(size))
    for s in size:
        assert target[s] * 0.97 - 60 <= taken[s] <= target[s] + 1e-6
    again = mixing.mix(docs.repartition(5), block_words=200, shard_words=1500).collect()
    key = lambda r: (r.doc_id or -1, [tuple(d) for d in r["_mix"].draws])
    assert sorted(map(key, got)) == sorted(map(key, again))
    rows_out = mixing.mixed_rows(docs, block_words=200, shard_words=1500)
    assert rows_out.columns == docs.columns
    assert rows_out.count() == sum(len(r["_mix"].draws) for r in got)
    assert mixing.mix(docs_table(spark, [])).count() == 0


def test_conversations_read_back(spark):
    said = r"\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", said, 5), (1, 0, "user", None, 5), (2, 0, "system: x\n", "<|image 0|> \\", 5), (2, None, None, "first", 5), (3, 0, "Assistant", "no loss", 5), (3, 0, "Assistant", "no loss", 5), (None, 0, "assistant", "é🙂" * 50_000, 5), (4, 0, "assistant", "", 5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted long")
    out = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(turns)).collect()}
    assert len(out) == len({r[0] for r in rows})
    for key, got in out.items():
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert (got.n_turns, got.loss_chars) == (len(mine), len(loss))
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.format_turns(turns.limit(0)).count() == 0


def test_parts_become_placeholders(spark):
    parts = [("text", "see ", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None), (None, " and <|", None, None, None, None, None), ("audio", None, "a.wav", None, None, 2.1, None), ("document", None, None, None, None, None, 3)]
    table = spark.createDataFrame([(1, 0, "assistant", parts), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    a, b = sorted(chat_format.format_turns(table, parts=F.col("parts")).collect(), key=lambda r: r.conv_id)
    assert a.formatted == "### assistant: see <|image 0|> and \\<|<|audio 1|><|document 2|></turn>\n"
    assert [(x.kind, x.ref, x.tokens) for x in a.attachments] == [("image", "i.png", 3), ("audio", "a.wav", 53), ("document", None, 1536)]
    assert all(a.formatted[x.start :].startswith(f"<|{x.kind} {x.number}|>") for x in a.attachments)
    assert "".join(chat_format.unescape(a.formatted[s.start : s.end]) for s in a.loss) == "see  and <|"
    assert a.placeholder_tokens == 1592 and b.formatted == "### user: </turn>\n" and not b.loss


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x="</p>"</script></head><body><nav><a>Home</a></nav><div id="top">Site of all pages</div>
<!-- no --><div class="ad-slot">Buy</div>{main}<div class="comments">Nice!</div><footer>&copy; {n}</footer></body></html>"""


def test_main_text_of_broken_pages():
    text = html_templates.main_text
    assert text("<article><h1>A &amp; B</h1><p><b>one  <i>t</i>wo<br>x<p>three\n four</p></article><p>out") == "A & B\n\none two x\n\nthree four"
    assert text("") == "" and text("   ") == "" and text("plain &lt; text") == "plain < text"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\n\nb\n\nc\n\nd"
    assert text("<header>h</header><p>x</p><aside>y</aside><form>z</form><div hidden>u</div><div role=search>s</div>") == "x"
    assert text("<div>" * 5000 + "deep") == "deep"
    assert text(PAGE.format(main="<article><p>A</p></article>", n=1)) == "A"


def test_what_recurs_on_a_site_goes(spark):
    rows = []
    for i in range(12):
        main = f"<div class=x><p>Story {i}</p><p>Quoted by all</p></div>" if i % 2 else f"<article><p>Story {i}</p><p>Quoted by all</p><div><a>Tell friends</a></div></article>"
        rows.append((i, "http://Host.example/a", PAGE.format(main=main, n=i), "h"))
    rows += [(100 + i, "http://other.example/", "<p>the same page</p>", "h") for i in range(9)]  # copies of one page
    rows += [(200, None, None, "h"), (201, "not a url", "<p>lone", "h"), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, templates string")
    out = {r.page_id: r for r in html_templates.extract_main_text(pages).collect()}
    assert out[0].text == "Story 0\n\nQuoted by all" and out[0].n_chars == 22
    assert out[1].text == "Story 1"  # without a main element, what recurs goes
    assert out[100].text == "the same page"
    assert out[200].text == "" and out[201].text == "lone"
    assert html_templates.extract_main_text(pages).count() == len(rows)
    assert html_templates.extract_main_text(pages.limit(0)).count() == 0


def test_what_recurs_inside_articles_goes_too(spark):
    rows = []
    for i in range(12):
        story = "".join(f"<p>Story {i} part {j} of <a>Ghana</a> <a>Read on</a></p>" for j in range(1 + i % 3))
        said = ["<p>Quoted here and there</p>" if j == i % 4 else f"<p>Words {i} {j}</p>" for j in range(4)]
        rows.append((i, "http://a/", f"<article>{story}{''.join(said)}<p>{i} ends</p><div class=box>Sign up for our weekly letter</div><p>All rights are with us</p></article>"))
        rows.append((100 + i, "http://b/", f"<div><p>The story {i} is told here</p></div><article>Card number {i}</article>"))
        rows.append((200 + i, "http://c/", f"<p>n{i}</p><article><h1>One story</h1><p>on many pages</p></article>"))
        rows.append((300 + i, "http://d/", f"<div><p>The story {i} is told here</p></div><article>The same card</article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_templates.extract_main_text(pages).collect()}
    for i in range(12):
        assert "Sign up" not in out[i] and "All rights" not in out[i]
        assert "Quoted here and there" in out[i] and f"Story {i} part {i % 3} of Ghana\n" in out[i] and out[i].endswith(f"{i} ends")
        assert out[100 + i] == f"The story {i} is told here\n\nCard number {i}"
        assert out[200 + i] == "One story\n\non many pages"
        assert out[300 + i] == f"The story {i} is told here"


def test_a_few_of_many_pages_make_a_template(spark):
    rows = []
    for i in range(200):
        menu = f"<div><p>Section {i // 10}</p><a>Go</a> | <a>Part {i // 10}</a><br>Told in <a>Ghana</a> on day {i}</div>"
        rows.append((i, "http://a/", f"{menu}<table><tr><td>Case {i}<td>{'yes' if i % 2 else i}<td>{i if i % 2 else 'yes'}</table><p>The story {i}</p>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_templates.extract_main_text(pages).collect()}
    assert out[7] == "| Told in Ghana on day 7\n\nCase 7\n\nyes\n\n7\n\nThe story 7"
    assert all("Section" not in x and "Part" not in x and "Ghana" in x for x in out.values())


def test_classifiers_learn_from_positive_and_unlabelled_texts(spark):
    rng = np.random.default_rng(1)
    words = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, truth = [], {}
    for i in range(1500):
        bad = i % 6 == 0
        text = list(rng.choice(words, int(rng.integers(20, 80))))
        for _ in range(4 if bad else 0):
            text.insert(int(rng.integers(len(text))), f"nasty{'abcdef'[int(rng.integers(6))]}")
        rows.append((i, " ".join(text)))
        truth[i] = int(bad)
    rows += [(5000, None), (5001, ""), (None, "nastya nastyb nastyc"), (5002, "nastyc " * 30_000)]
    docs = docs_table(spark, rows).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, truth[i]) for i in range(0, 1500, 2)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    models = pu_toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in pu_toxicity.score(docs, models).withColumn("h", pu_toxicity.held_out(F.col("doc_id"))).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    unseen = [(truth[k], r.score >= 0.7) for k, r in got.items() if k in truth and (r.h or k % 2)]
    assert np.mean([p for t, p in unseen if t]) > 0.95 and np.mean([p for t, p in unseen if not t]) < 0.02
    assert got[5000].score == got[5001].score < 0.7 and got[None].score >= 0.7 and got[5002].score >= 0.5
    assert all(r.score == 0 for r in pu_toxicity.score(docs.limit(3), pu_toxicity.fit(docs, labels.limit(0))).collect())
    clean = pu_toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns and clean.count() == sum(r.score < 0.7 for r in got.values())


def test_held_out_labels_are_not_read(spark):
    import zlib

    docs = docs_table(spark, [(i, f"text {i} nasty") for i in range(60)])
    labels = spark.createDataFrame([(i, 1) for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1], "doc_id long, toxic int")
    assert pu_toxicity.fit(docs, labels).count() == 0


def test_marks_are_whole_words():
    assert not re.search("ad", "".join(x for x in html_templates.MARKS if x == "shadow"))
    assert html_templates.main_text('<div class="shadow loader">kept</div><div class="page-adSlot">kept too</div><div class="ad">no</div>') == "kept"
