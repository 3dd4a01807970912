"""Template residue and notices by cases."""

from regatlas.llm import residue as rs

SOUND = "The level shifter of DEMO validates the packed header before the first transfer, and software reads the status back afterwards."
FOUND = {
    "placeholder": [f"Intro {{{{ product_name }}}} {SOUND}", f"{SOUND} <enter version> now", "[INSERT MODULE HERE] text", "see %part-number% end", "a __doc.owner__ b", "<<name>> x", "@@author@@", "${a.b} c", "#{x}", "<%= y %>", "{% block z %}", "[[title]]"],
    "filler": ["Lorem ipsum ferra dolum silva caleo ponti gravis.", f"{SOUND}\nxxxx xxxxx xx xxx xxxx", "Sample text goes here.", "Ferra dolum silva caleo ponti gravis ferra dolum."],
    "notice": [
        "404 - Page not found.", "Menu  Close\n\nAccess denied. You do not have permission to view DEMO.", "Please enable JavaScript to view this manual.\n\nDEMO Clocking", "Loading this manual, please wait ...",
        "页面不存在，请返回首页。", "Zugriff verweigert. Bitte melden Sie sich erneut an.", "Fatal error: template engine could not open file chapter_1 on line 3",
    ],
}
FINE = [
    SOUND, None, "", "ok", f"{SOUND}\n```c\nint a[] = {{{{0}}, {{n}}}};\nprintf(\"%s\", name);\n```", "A missing value is shown as <none> or as {} by software.", "The placeholder bits <7:3> of DEMO are reserved.",
    "Readers of the DEMO log who meet the words 'please enable JavaScript' should set DEMO_A to 0x1.", "A page not found in the mailbox raises the strobe, and the driver must merge the entry.", f"Access denied.\n{SOUND}",
    "Error 500 in the log of DEMO means that the arbiter did not hold the entry.", "use `{{ name }}` in templates of the generator", "```\n{% if X %} {{ y }}",
]


def test_cases(spark):
    texts = [(t, k) for k, ts in FOUND.items() for t in ts] + [(t, None) for t in FINE]
    docs = spark.createDataFrame([(i, t, "host", "x") for i, (t, _) in enumerate(texts)], "doc_id long, text string, source string, line string")
    got = {}
    for r in rs.residue(docs.union(docs)).collect():
        got.setdefault(r.doc_id, set()).add(r.reason)
    assert got == {i: {k} for i, (_, k) in enumerate(texts) if k}


def test_recurrent_banner_is_furniture(spark):
    banner = "Please enable JavaScript to view this manual."
    docs = [(i, f"{banner}\n{SOUND} {'abcdefgh'[i]}", "h") for i in range(8)] + [(99, banner, "h"), (100, banner, None)]
    got = {r.doc_id for r in rs.residue(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert got == {100}


def test_empty_and_long(spark):
    docs = spark.createDataFrame([(1, (SOUND + "\n") * 5000 + "{{ name }}", "h")], "doc_id long, text string, source string")
    assert [r.reason for r in rs.residue(docs).collect()] == ["placeholder"]
    assert rs.residue(docs.where("false")).count() == 0
