import html
import itertools
import re

import pytest

from meterlake.llm import wrapper


def page(body, nav="Home", note="Subscribe now", ad="Buy this", article=True):
    inner = f"<article><h1>Title of {body[:6]}</h1>{''.join(f'<p>{b}' for b in body.split('|'))}<div>{note}</div></article>" if article else f"<div class=text><p>{body}</p></div><div>{note}</div>"
    return f"<!DOCTYPE html><html><head><title>t</title><script>var x='<p>no</p>';</script></head><body><nav><a href=x>{nav}</a></nav><!-- <p>no --><div class='side ad'>{ad}</div>{inner}<section id=comments><p>reader</p></section><footer>f</footer></body></html>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, template string")


def test_template_inside_the_article(spark):
    rows = [(k, f"https://A.example.com/{k}", page(f"text {k} &amp; more|second{k}", ad=f"ad {k}")) for k in range(12)] + [(99, "https://b.example.com/1", page("alone|again"))]
    got = {r["page_id"]: r["text"] for r in wrapper.extracted(frame(spark, rows)).collect()}
    assert got[3] == "Title of text 3\n\ntext 3 & more\n\nsecond3"
    assert got[99] == "Title of alone|\n\nalone\n\nagain\n\nSubscribe now"  # one page tells nothing about its template


def test_pages_without_an_article(spark):
    rows = [(k, "http://c.example.com", page(f"text number {k}", nav=f"n{k}", article=False)) for k in range(10)]
    assert {r["text"] for r in wrapper.extracted(frame(spark, rows)).collect()} == {f"text number {k}" for k in range(10)}


def test_copies_prove_no_template(spark):
    rows = [(k, "http://d.example.com", page("all the same|text")) for k in range(30)]
    assert {r["text"] for r in wrapper.extracted(frame(spark, rows)).collect()} == {"Title of all th\n\nall the same\n\ntext\n\nSubscribe now"}


NOTICE = "Subscribe now"


def hosts(n, name="f", **more):
    return [(k, f"https://{name}.example.com/{k}", page(f"text {k} of many|second {k}", **more)) for k in range(n)]


def texts_of(spark, rows, **options):
    return [r["text"] for r in wrapper.extracted(frame(spark, rows), **options).collect()]


def test_one_deviating_page_does_not_save_the_notice(spark):
    rows = hosts(200)
    whole = rows[0][2]
    rows[0] = (0, rows[0][1], whole[: whole.index(NOTICE) + 11])  # cut off inside the notice
    rows[1] = (1, rows[1][1], rows[1][2].replace(NOTICE, "Subscribe today"))
    got = texts_of(spark, rows)
    assert len(got) == 200 and not any("Subscribe" in t for t in got) and sum("second" in t for t in got) == 200
    assert all(NOTICE in t for t in texts_of(spark, rows[2:], articles=10**6))  # the method, and nothing else, took it out


def test_a_host_of_seven_pages_is_judged_by_the_same_rule(spark):
    got = texts_of(spark, hosts(7))
    assert len(got) == 7 and not any(NOTICE in t for t in got) and all("text" in t for t in got)


def test_a_constant_paragraph_among_varying_ones(spark):
    rows = [(k, f"https://g.example.com/{k}", page(f"text {k} of many|Sign up for our letter|" + "|".join(f"part {j} of {k}" for j in range(k % 4)))) for k in range(40)]
    got = texts_of(spark, rows)
    assert not any("letter" in t for t in got) and sum(t.count("part") for t in got) == sum(k % 4 for k in range(40))


def test_a_notice_the_reference_lacks(spark):
    rows = [(k, u, h.replace("<div>Subscribe now</div>", "") if k % 2 == 0 else h) for k, u, h in hosts(40)]
    got = texts_of(spark, rows)
    assert len(got) == 40 and not any(NOTICE in t for t in got)


def test_near_copies_of_one_article_keep_their_text(spark):
    rows = [(k, f"https://h.example.com/{k}", page(f"short {k}|the one long paragraph that all the copies of this article share|end")) for k in range(30)]
    assert all("the one long paragraph" in t and "end" in t for t in texts_of(spark, rows))


def brute_template(pages, share=wrapper.SHARE, articles=wrapper.ARTICLES):
    """(slot, text) pairs by counting pages one by one, and slots that hold hardly anything else."""
    trees = [wrapper.slots(wrapper.parse(p)) for p in pages]
    reference = wrapper.numbered(wrapper.unpacked(wrapper.packed(trees[0])))
    longest = [wrapper.longest(t) for t in trees]
    have, members, seen, occurs = {}, {}, {}, {}
    for tree, article in zip(trees, longest):
        for k, slot in wrapper.aligned(tree, reference):
            if slot.texts:
                have[k], members[k] = have.get(k, 0) + 1, members.get(k, 0) + len(slot.texts)
                for t in set(slot.texts):
                    seen.setdefault((k, t), []).append(article[t == article[0]])
                    occurs[k, t] = occurs.get((k, t), 0) + slot.texts.count(t)
    constant = {(k, t) for (k, t), found in seen.items() if len(found) >= share * have[k] and len({a % 63 for a in found}) >= articles}
    whole = {k for k, _ in constant if sum(occurs[c] for c in constant if c[0] == k) >= share * members[k]}
    return sorted({(k, -1) if k in whole else (k, t) for k, t in constant})


def test_induction_equals_brute_force(spark):
    import random

    rnd = random.Random(6)
    pages = [page(f"text {k} of many|{rnd.choice(['Sign up', 'Sign up', 'Sign up', 'no'])}|second {k}|Share this", note=rnd.choice([NOTICE] * 30 + ["other"])) for k in range(60)]
    rows = frame(spark, [(k, "https://i.example.com/", p) for k, p in enumerate(pages)]).selectExpr("page_id", "'i' as host", "html")
    stored = wrapper.trees(rows)
    found = wrapper.templates(stored, wrapper.references(stored)).collect()
    assert [(e["slot"], e["text"]) for e in found[0]["template"]] == brute_template(pages)


def test_pages_of_hosts_without_a_template_do_not_shuffle(spark):
    plan = wrapper.extracted(frame(spark, [(k, f"https://n{k}.example.com/", page(f"t{k}")) for k in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(host") <= 2  # only behind the Bloom filter


def test_edges(spark):
    whole = page("one|two|three")
    rows = [(1, None, None), (2, "", ""), (3, "no url", "plain text"), (4, "http://e.example.com/", whole[: whole.index("three") + 2]), (4, "http://e.example.com/", whole[: whole.index("three") - 2]), (None, "http://e.example.com/", "<p>a<br>b &copy c &#x41;<p>  d\n\te <b>f</b>g</p><li>h<li>i" + "<div>" * 3_000 + "deep")]
    got = [(r["page_id"], r["text"]) for r in wrapper.extracted(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (2, ""), (3, "plain text"), (4, "Title of one|tw\n\none\n\ntwo\n\nth"), (4, "Title of one|tw\n\none\n\ntwo"), (None, "a b © c A\n\nd e fg\n\nh\n\ni\n\ndeep")], key=str)
    assert wrapper.extracted(frame(spark, rows).limit(0)).count() == 0


def brute_match(a, b):
    """Simple tree matching over every order-keeping choice of child pairs."""
    if a.name != b.name:
        return 0
    best = 0
    n, m = len(a.children), len(b.children)
    for k in range(min(n, m) + 1):
        for left in itertools.combinations(range(n), k):
            for right in itertools.combinations(range(m), k):
                best = max(best, sum(brute_match(a.children[i], b.children[j]) for i, j in zip(left, right)))
    return best + 1


@pytest.mark.parametrize("seed", range(20))
def test_tree_matching(seed):
    import random

    rnd = random.Random(seed)

    def tree(depth):
        return "".join(f"<{(t := rnd.choice(['div', 'ul', 'table']))}>x{tree(depth - 1)}</{t}>" for _ in range(rnd.randint(0, 3))) if depth else ""

    a, b = (wrapper.slots(wrapper.parse(tree(3))) for _ in range(2))
    assert wrapper.match(a, b) == brute_match(a, b)
    assert len(wrapper._align(a, b)[1]) == wrapper.match(a, b)
    assert wrapper.packed(wrapper.unpacked(wrapper.packed(a))) == wrapper.packed(a)


def test_query_on_the_given_pages(spark, sf_dir):
    """The given pages mark their article; its blocks are what stands between tags."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in wrapper.op4(spark, sf_dir).collect():
        inside = re.sub(r"</article>.*", "", pages[r["page_id"]].split("<article>", 1)[-1], flags=re.S)
        inside = re.sub(r"<br>", " ", re.sub(r"</?b>", "", inside))
        texts = [re.sub(r"\s+", " ", html.unescape(t)).strip() for t in re.split(r"<[^>]*>|<[^>]*\Z", inside)]
        assert r["text"] == "\n\n".join(t for t in texts if t) and r["n_chars"] == len(r["text"])
