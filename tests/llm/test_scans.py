"""Personal data, secrets and HTML text."""

import os
import random
import re
import string

import pytest

from fieldlens.llm import html_text, pii, queries, secret_scan
from tests.llm import brute

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

ODD = ["", None, "a@b.c.d@e.f", "a@b-c.d_x@e.f _y@z.w @x.y a@@b.c x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
       "\U0001F600é +1 (706) 555-3138 +12 4111 1111 1111 1111 4111-1111-1111-11112", "4111111111111111 and +33 1 23 45 67 89. +1-2-3",
       "9" * 5000, "a." * 3000 + "@x.y." + "z." * 3000, "+1 " + "2 " * 40, "x" * 200_000, "\n\n \t"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, body string")


@needs_data
@pytest.mark.parametrize("name", ["op8_pii", "op6_secret_scan"])
def test_queries_match_brute_force(spark, name):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    find, kinds = (brute.pii, ("email", "ip", "card", "phone")) if name == "op8_pii" else (brute.secrets, ("assign", "access", "hex"))
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = find(docs[r.doc_id])
        assert r.base_sha256 == brute.digest(want)
        assert [r[f"n_{k}"] for k in kinds] == [sum(w[0] == k for w in want) for k in kinds]
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(r.spans.split(","))


def test_pii_odd_texts(spark):
    rows = pii.find_pii(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD) and rows[0].body == "x"
    for r in rows:
        base = [(p.kind, p.start, p.end) for p in r.pii if p.kind in pii.BASE_KINDS]
        assert base == brute.pii(r.text)
    assert pii.find_pii(frame(spark, ["t"]).limit(0)).count() == 0


def test_pii_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1", "host 0.0.0.0 up", "1.2.3.00", "192.168.0.1, 127.0.0.1", "000.00.0.0255", "0.0.0.256", "0.0.0.", "0..0.0", "09.99.100.0249"]
    for r in pii.find_pii(frame(spark, texts)).collect():
        assert [(p.kind, p.start, p.end) for p in r.pii if p.kind == "ip"] == [w for w in brute.pii(r.text) if w[0] == "ip"]
        assert len(r.pii) == (1, 1, 1, 2, 1, 0, 0, 0, 1)[r.doc_id]


def test_pii_validators_and_context(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok DE89370400440532013000 and GB82 WEST 1234 5698 7654 33",
             "ssn 123-45-6789, then a long way off from any hint at all, 123-45-6789", "666-12-1234 ssn",
             "amex card 378282246310005", "number 378282246310005 alone"]
    found = {r.doc_id: [(p.kind, r.text[p.start:p.end]) for p in r.pii] for r in pii.find_pii(frame(spark, texts)).collect()}
    assert found == {0: [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")], 1: [("ssn", "123-45-6789")],
                     2: [], 3: [("short_card", "378282246310005")], 4: []}
    scores = {r.doc_id: [round(p.score, 2) for p in r.pii] for r in pii.find_pii(frame(spark, ["email a@b.c", "zz a@b.c"])).collect()}
    assert scores == {0: [1.0], 1: [0.9]}


def test_native_operators_run_no_python(spark):
    from fieldlens.llm import quality_rules
    for df in (pii.find_pii(frame(spark, ODD)), quality_rules.apply_rules(frame(spark, ODD))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secrets_base_spans():
    for text in ["api_key = 'abcdef'", "APIKEY:\"zzzzzz\" token=short PASSWORD  :   longenough", "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "AKIA",
                 "deadbeef" * 3, "deadbee" * 3, "ToKen=abcdefg", "seſret=abcdefg", "secret=secret=abcdef", "token=ab token=abcdefg"]:
        assert [(secret_scan.KINDS[k], s, e) for s, k, e in sorted(secret_scan.base_spans(text))] == brute.secrets(text)


def test_randomness_battery_separates_keys_from_words(spark):
    rng = random.Random(3)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.choice((24, 40, 64)))) for _ in range(300)]
    words = ["-".join(rng.choice(["report", "server2", "data", "value", "name", "update", "index7"]) for _ in range(6)) for _ in range(300)]
    df = frame(spark, [f"see {t} here" for t in keys + words] + ODD)
    found = {r.doc_id: [s.kind for s in r.secrets] for r in secret_scan.find_secrets(df).collect()}
    hits = sum("random" in found[i] for i in range(300))
    false = sum("random" in found[i] for i in range(300, 600))
    assert hits >= 240 and false <= 0.1 * (hits + false) + 5
    assert found[600] == [] and found[601] == []
    assert secret_scan.find_secrets(df.limit(0)).count() == 0


def test_keys_beside_separators_and_without_digits(spark):
    rng = random.Random(4)
    text = "x /srv/my-app/QmZkTrWvYpLsXaBn+ prefix_ab1/cd2+ef3/gh4+ij5 KLMNOPQRSTUVWXYZ 1234567890123456 sha-0123456789abcdef01=="
    tokens = {text[s:e] for s, e, _, _ in secret_scan.candidates(text)}
    assert {"QmZkTrWvYpLsXaBn", "ab1/cd2+ef3/gh4+ij5", "KLMNOPQRSTUVWXYZ", "0123456789abcdef01=="} <= tokens
    assert "1234567890123456" not in tokens
    url = string.ascii_letters + string.digits + "-_"
    plain = string.ascii_letters + string.digits + "+/"
    keys = ["".join(rng.choices(url, k=40)) for _ in range(300)] + ["".join(rng.choices(plain, k=40)) for _ in range(300)]
    keys += [k for k in ("".join(rng.choices(plain, k=18)) for _ in range(12_000)) if not any(c.isdigit() for c in k)][:300]
    texts = [f"see https://x.org/my-app/{k} here" for k in keys[:300]] + [f"see my_prefix_{k} here" for k in keys[300:600]] + [f"see {k} here" for k in keys[600:]]
    rows = secret_scan.find_secrets(frame(spark, texts)).collect()
    hits = [any(s.kind == "random" and keys[r.doc_id] in r.text[s.start:s.end] for s in r.secrets) for r in sorted(rows, key=lambda r: r.doc_id)]
    assert sum(hits[:300]) >= 240 and sum(hits[300:600]) >= 240 and sum(hits[600:]) >= 150
    words = frame(spark, [f"the internationalisation of state-of-the-art/{w}-management-systems_and" for w in ("data", "value", "record")] * 50)
    assert not any(r.secrets for r in secret_scan.find_secrets(words).collect())


def test_html_layout():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
    <body><h1>Head &amp; more</h1><p>one<p>two <b>bold</b>ly<br>next   line<div style="color:red; display : none">no</div>
    <span hidden>no</span><ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>
    <table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table><pre>  keep
   this</pre><!-- no --><noscript>no</noscript><dl><dt>t<dd>d</dl>tail"""
    assert html_text.visible_text(page) == "\n".join([
        "Head & more", "", "one", "", "two boldly", "next line", "", "- a", "- b", "  3. c", "  4. d", "",
        "name       n", "long name  1", "x          22", "", "  keep", "   this", "", "t", "  d", "", "tail"])


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "</p></table>x", "<table><td>a", "<div>" * 3000 + "deep" + "</div>" * 3000,
                                  "<ol start='x'><li>a", "<p>a</p " + "b" * 100, "<![CDATA[x]]>", "<a href=x>" * 1000, "&#0;&bogus;&#x110000;"])
def test_html_never_fails(page):
    assert isinstance(html_text.visible_text(page), str)


def test_html_deep_text_is_kept():
    assert html_text.visible_text("<div>" * 3000 + "deep") == "deep"


def test_html_below_many_open_tags():
    """Visibility and layout do not depend on the depth."""
    page = "<script>no</script><p style='display:none'>no</p><ul><li>a<li>b</ul><table><tr><td>long name<td>1<tr><td>x<td>2</table><pre> k\n  l</pre>z"
    shown = html_text.visible_text(page)
    assert "no" not in shown
    for tag in ("<font>", "<b>", "<a href=x>"):
        assert html_text.visible_text(tag * 5000 + page) == shown
    assert html_text.visible_text("<pre>" + "<b>" * 5000 + "x\n  y") == "x\n  y"
    assert html_text.visible_text("<p><button>" + "<font><section>x" * 20_000).count("x") == 20_000
    assert html_text.visible_text("<ul><li>a" * 1000).count("- a") == 1000


@pytest.mark.parametrize("tag", ["strong", "em", "font", "label", "button", "u", "x-own"])
def test_html_head_ends_at_text_and_other_tags(tag):
    assert html_text.visible_text("<head><title>T</title>Hello<p>more") == "Hello\n\nmore"
    assert html_text.visible_text(f"<head><title>T</title><style>s</style>\n<{tag}>Hello<p>more") == "Hello\n\nmore"
    assert html_text.visible_text(f"<head><meta name=a><noscript>no</noscript></head><{tag}>Hello</{tag}>") == "Hello"
    assert html_text.visible_text("<head><title>T</title><img alt=pic> x") == "pic x"


def test_html_form_fields():
    text = html_text.visible_text
    assert text("<p>a <textarea>typed <b>x</textarea> b") in ("a typed x b", "a typed <b>x b")
    assert text("a<textarea>\none\n  two</textarea>b") == "a\none\n  two\nb"
    assert text("a <select><option>one<option selected>two<option>three</select> b") == "a two b"
    assert text("a <select><option disabled>pick<optgroup label=g><option>one</optgroup></select>") == "a one"
    assert text("<select multiple><optgroup label=g><option>one<option label=2>two<option hidden>no</select>") == "g\none\n2"
    assert text("<div hidden><select><option>no</select><textarea>no</textarea></div>x") == "x"


def test_html_text_outside_of_cells_is_kept():
    page = "<table>stray <b>words</b><tr>more<td>a<td>bb<tbody><div>block</div><tr><td>cc<td>d</table>"
    assert html_text.visible_text(page) == "stray wordsmore\nblock\na   bb\ncc  d"
    assert html_text.visible_text("<table><tr><td>" * 1000 + "x").endswith("x")


def test_html_unfinished_tags_cost_linear_time():
    assert html_text.visible_text("<p>a < b" + "<a " * 100_000) == "a < b"
    assert html_text.visible_text("x > y" + "<" * 50_000).startswith("x > y")


def test_html_frame(spark):
    df = spark.createDataFrame([(1, None, "<p>x"), (2, "u", None), (2, "u", None), (None, "u", ""), (4, "u", "<td>é</td>")],
                               "page_id long, text string, html string")
    got = sorted(((r.page_id, r.text) for r in html_text.extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "x"), (2, None), (2, None), (None, ""), (4, "é")], key=repr)
    assert html_text.extract_text(df.limit(0)).count() == 0


def spelled(row):
    return [(x.kind, x.start, x.end) for x in row.secrets]


@needs_data
def test_all_spans_match_brute_force_on_the_tables(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want = brute.all_secrets([r.text for r in rows])
    got = {r.doc_id: r.spans for r in queries.op6_secret_scan(spark, SF).collect()}
    assert got == {r.doc_id: ",".join(f"{k}:{s}:{e}" for k, s, e in spans) for r, spans in zip(rows, want)}


def test_all_spans_match_brute_force_on_keys(spark):
    """Keys of all encodings and lengths, bare, behind separators, in known
    patterns and padded, among words; with cut-offs from these texts."""
    rng = random.Random(9)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_letters + string.digits + "+/",
                 string.ascii_letters + string.digits + "-_", string.ascii_letters]
    texts = []
    for i in range(600):
        key = "".join(rng.choices(rng.choice(alphabets), k=rng.choice((16, 17, 20, 24, 32, 40, 64, 90))))
        word = "-".join(rng.choices(["report", "server2", "data", "value", "update_all", "a/b/c", "index7"], k=5))
        texts.append(rng.choice(["see {k} and {w}", "/srv/my-app/{k}/{w}", "token={k};{w}", "{k}==={w}", "{w}_{k}", "AKIA{k} {k}", "{w}"]).format(k=key, w=word))
    texts += [t for t in ODD if t is None or len(t) < 10_000]
    want = brute.all_secrets(texts)
    assert sum(k == "random" for spans in want for k, _, _ in spans) > 200
    got = {r.doc_id: spelled(r) for r in secret_scan.find_secrets(frame(spark, texts)).collect()}
    assert got == dict(enumerate(want))


def test_very_many_secrets_take_linear_time(spark):
    import time
    rng = random.Random(10)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=32)) for _ in range(10_000)]
    text = " ".join(f"token={k} {k[::-1]}" for k in keys)
    began = time.time()
    row = secret_scan.find_secrets(frame(spark, [text])).collect()[0]
    assert time.time() - began < 60
    assert sum(x.kind == "assign" for x in row.secrets) == 10_000 and sum(x.kind == "random" for x in row.secrets) > 8_000


@needs_data
def test_html_query_matches_a_plain_renderer(spark):
    """Whole texts of all pages against markup rewritten by substitution."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op7_html_text(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    known = re.compile("!doctype|html|head|body|meta|title|style|script|nav|ul|li|a|p|b|br|div|article|h1|footer", re.I)
    for r in rows:
        page = re.sub(r"(?s)<!--.*?-->", "", pages[r.page_id])
        assert all(known.fullmatch(tag) for tag in re.findall(r"</?([!a-zA-Z0-9]+)", page)), "a tag that brute.html does not know"
        assert r.text == brute.html(pages[r.page_id]), r.page_id


def test_html_cells_over_columns_and_rows():
    text = html_text.visible_text
    assert text("<table><tr><td colspan=2>wide heading<td>z<tr><td>a<td>b<td>c</table>") == "wide heading  z\na  b          c"
    assert text("<table><tr><td rowspan=2>tall<td>z<tr><td>b<td>c<tr><td>1<td>2<td>3</table>") == "tall  z\n      b  c\n1     2  3"
    # rowspan 0 and too large ones end with their group
    for rows in (0, 99):
        assert text(f"<table><tbody><tr><td rowspan={rows}>x<td>a<tr><td>b<tbody><tr><td>c<td>d</table>") == "x  a\n   b\nc  d"
    # a cell ends where one from above stands; broken numbers count as one
    assert text("<table><tr><td>a<td rowspan=2>b<td>c<tr><td colspan=3>d<td>e</table>") == "a  b  c\nd     e"
    assert text("<table><tr><td colspan=x>a<td colspan=-1>b<td rowspan=''>c<tr><td>1<td>2<td>3</table>") == "a  b  c\n1  2  3"
    # lines of a cell stay below each other; a row without text only takes its columns
    assert text("<table><tr><td>a<br>b<td>c<tr><td rowspan=2><td><tr><td>d</table>") == "a  c\nb\n   d"
    # a cell wider than any gap moves nothing in other rows
    assert text(f"<table><tr><td>{'w' * 500}<td>x<tr><td>a<td>b</table>") == "w" * 500 + "  x\na  b"


def test_html_cells_stand_in_their_columns():
    """Random spans against a grid that is filled slot by slot."""
    rng = random.Random(7)
    for _ in range(200):
        rows = [[(rng.randint(1, 3), rng.randint(0, 3), [f"{r}.{c}"]) for c in range(rng.randint(1, 5))] for r in range(rng.randint(1, 7))]
        groups = sorted(rng.randint(0, 1) for _ in rows)
        slots: dict[tuple[int, int], bool] = {}
        want = []
        for r, cells in enumerate(rows):
            column, placed = 0, []
            last = max(k for k, g in enumerate(groups) if g == groups[r]) + 1
            below = []
            for wide, deep, lines in cells:
                while (r, column) in slots:
                    column += 1
                end = column + 1
                while end < column + wide and (r, end) not in slots:
                    end += 1
                below += [(k, c) for k in range(r, last if deep == 0 else min(r + deep, last)) for c in range(column, end)]
                placed.append((column, end, lines))
                column = end
            slots |= dict.fromkeys(below, True)
            want.append(placed)
        assert html_text._placed(list(zip(groups, rows))) == want
        at = {}
        for line in html_text._aligned([p for p in want if len(p) > 1]):
            for m in re.finditer(r"[0-9]+\.[0-9]+", line):
                r, c = map(int, m[0].split("."))
                assert at.setdefault(want[r][c][0], m.start()) == m.start()


def test_html_visibility_is_inherited_and_the_last_declaration_counts():
    text = html_text.visible_text
    assert text("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b><i>no</i></div>") == "yes"
    assert text("<p style='display:none;display:block'>a<p style='display:block;display:none'>b") == "a"
    assert text("<p style='display:none!important;display:block'>a<p style='display:none;display:nonsense'>b<p style='/*display:none*/'>c") == "c"
    assert text("<p style='DISPLAY : NONE'>a<p hidden style='display:block'>b<p hidden>c<p style='x-display:none'>d") == "b\n\nd"
    assert text("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>x</ul>") == "- x"
    assert text("<ol><li style='visibility:hidden'>no<li>x</ol>") == "2. x"
    assert text("<table><tr style='visibility:collapse'><td>no<td>no<tr><td>a<td>b</table>") == "a  b"
    assert text("<pre style='visibility:hidden'>no <b style='visibility:visible'>x</b></pre>") == "x"
    assert text("<details><summary>S</summary>no<summary>no</summary></details><details open><summary>S</summary>yes</details>") == "S\nS\nyes"
    assert text("<input type=submit value=Go><input value=' typed '><input type=hidden value=no><input type=checkbox value=no>"
                "<input type=image alt=pic><input type=submit>") == "Gotypedpic"


def test_html_long_lines_and_tables_take_linear_time():
    import time
    for page, n in (("<p>" + "a<b>x</b>" * 100_000, 100_000),
                    ("<table>" + "".join(f"<tr><td rowspan={50_000 - i}>a" for i in range(10_000)), 10_000),
                    ("<table>" + "<tr><td colspan=1000>a<td>b" * 20_000, 20_000),
                    ("<table><tr><td>" + "a<br>" * 50_000 + "<td>b" * 50_000, 50_000)):
        began = time.time()
        assert html_text.visible_text(page).count("a") == n
        assert time.time() - began < 20


def test_very_many_matches_take_linear_time(spark):
    import time
    text = "".join(f"mail a{i}@b.io or call +49 {i:09d}, " for i in range(50_000))
    df = spark.createDataFrame([(1, text), (2, text[:20_000])], "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r.pii for r in pii.find_pii(df).collect()}
    assert time.time() - began < 60
    for doc, whole in ((1, text), (2, text[:20_000])):
        found = [(s.start, s.end) for s in rows[doc] if s.kind == "email"]
        assert found == [m.span() for m in re.finditer(r"[a-z0-9]+@b\.io", whole)]
