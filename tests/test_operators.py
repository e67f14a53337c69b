"""Hand-written cases for the branches that the given tables do not reach."""

import random

import pytest
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.functions import vocab as V
from wordtide.operators import audit, matching, names, pages, phrases, sampling, series
from wordtide.sources import readers, sinks


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_vocabulary_sizes():
    assert len(V.LEGACY_TERMS) == 43 and len(V.EXTRA_TERMS) == 75 and len(V.ROOTS) == 51 and len(V.STOP_WORDS) == 38
    readers.check_roots(V.ROOTS)
    readers.check_groups(V.SUFFIX_GROUPS)
    with pytest.raises(ValueError):
        readers.check_groups([("a", 50, ("com",)), ("b", 50, ("com",))])
    with pytest.raises(ValueError):
        readers.check_roots(["a", "A"])


def test_domain_errors(spark):
    long_name = ".".join(["x" * 60] * 5)
    given = ["Good.Example.COM.", "", None, "a b.com", "http://a.com", "a..com", "-a.com", "a.123", "1.2.3.4", "nodot", "x" * 300 + ".com", long_name, "bücher.de", "ok.io", ".com", "a.com..", "x" * 64 + ".com", "éü" * 30 + ".de", "xn--é.de"]
    want = [None, "blank_line", "blank_line", "embedded_whitespace", "not_a_bare_domain", "idna_encoding_failed", "invalid_dns_label", "numeric_top_level_label",
            "numeric_top_level_label", "missing_dot", "idna_encoding_failed", "hostname_too_long", None, None, "idna_encoding_failed", "invalid_dns_label", "idna_encoding_failed", "idna_encoding_failed", "idna_encoding_failed"]
    assert column(spark, given, T.domain_error) == want
    assert column(spark, given, T.domain_of)[0] == "good.example.com"
    loose = ["Good.Example.COM...", "a.123", "1.2.3.4", "a\tb.com", "1.2.3.4.5", "999.1.1.1", "x.y\x1f"]
    assert column(spark, loose, lambda c: T.domain_error(c, False)) == [None, None, "ip_address", "embedded_whitespace", None, None, "embedded_whitespace"]


def test_names_in_ascii(spark):
    labels = ["bücher", "münchen", "日本語", "ü", "éé", "aé日b語", "россия", "ελλάδα", "a-ü-b", "ñandú2024", "🙂", "中" * 15, "abcdefghijklmnopqrstuvwxyzäöü" * 1, "zażółćgęśląjaźń"]
    assert column(spark, labels, T.punycode) == [x.encode("punycode").decode() for x in labels]
    names = ["bücher.de", "a.com", None, "日本語。ｃｏｍ", "straße.de", "www.münchen.de.", "x.ü"]
    assert column(spark, names, T.ascii_name) == [None if n is None else n.encode("idna").decode() for n in names]
    raw = ["  BÜCHER.de. ", "ﬁsch.de"]
    assert column(spark, raw, T.domain_of) == ["xn--bcher-kva.de", "fisch.de"]


def test_text_helpers(spark):
    assert column(spark, ["  Straße  X ", None], T.canonical) == ["strasse x", None]
    assert column(spark, ["=1+1", " +x", "plain", "-", None], T.guarded_cell) == ["'=1+1", "' +x", "plain", "'-", None]
    assert column(spark, ["a/2026-02-30.txt", "x-2026-02-03.txt", "none"], T.source_date)[0::2] == [None, None]
    assert column(spark, ["HTTP/1.1 301\r\nLocation: /a\r\n\r\nHTTP/1.1 200\r\nlocation: /b\r\n"], lambda c: T.header_value(c, "Location")) == ["/b"]
    assert column(spark, [0, 6, 28, 99, None], T.error_kind, "int") == [None, "dns", "timeout", "transport", None]
    assert column(spark, ["</script>"], T.script_safe) == ["<\\/script>"]
    assert column(spark, ["a?token=s3 wss://h/x"], T.scrubbed) == ["a?token=*** wss://***"]
    assert column(spark, ["<a&'\">"], T.escaped_html) == ["&lt;a&amp;&#x27;&quot;&gt;"]


def test_channels(spark):
    given = ["pdfmaker", "quizhub", "sunny-day", "xn--pdf", "pdf123", "x" * 40 + "pdf", "magento", "q9"]
    df = names.classify_channel(spark.createDataFrame([(n,) for n in given], "name string"))
    got = {r["name"]: r["channel"] for r in df.collect()}
    assert [got[n] for n in given] == ["legacy_terms", "expanded_terms", "name_exploration", "unrestricted_exploration", "unrestricted_exploration",
                                       "unrestricted_exploration", "unrestricted_exploration" if "agent" not in "magento" else "legacy_terms", "unrestricted_exploration"]


def test_segments(spark):
    lexicon = spark.createDataFrame([(w,) for w in "note book notebook keeper map maker ab aaa aaaa bcd aab cd".split()], "word string")
    want = {
        "notebook": ["notebook"], "mapmaker": ["map", "maker"], "notekeeper": ["note", "keeper"], "mapx": None, "xyzxyz": None, "map-maker": ["map", "maker"], "map-": None,
        "-map": None, "map--maker": None, "map": ["map"], "ab": None, "": None, None: None, "note-book-map-map-map": ["note", "book", "map", "map", "map"],
        "notebook-map-map-map-map": ["notebook", "map", "map", "map", "map"], "mapmapmapmapmapmap": None, "aaaaaaa": ["aaa", "aaaa"], "aaabcd": ["aaa", "bcd"], "no-te": None,
    }
    rows = spark.createDataFrame([(n, 1) for n in want] + [("map", 2)], "name string, n int")
    got = names.with_segments(rows, lexicon).collect()
    assert len(got) == len(want) + 1 and {r["name"]: r["segments"] for r in got} == want
    assert names.with_segments(rows, lexicon.where("false")).where("segments is not null").count() == 0
    forms = names.with_segments(spark.createDataFrame([("map-4-maker",), ("map2",)], "name string"), lexicon, names.lexical_form(F.col("name"))).collect()
    assert {r["name"]: r["segments"] for r in forms} == {"map-4-maker": ["map", "maker"], "map2": ["map"]}


def test_name_paths(spark):
    given = [("solar", None, "short_abbreviation"), ("lumora42", None, "alphanumeric_exploration"), ("xqzvbnkl4", ["some"], "alphanumeric_exploration"), ("a-1-b", None, "alphanumeric_exploration"), ("xqzvbnkl4w", None, None), ("notekeeper", ["note", "keeper"], "dictionary_segments"), ("lumora", None, "readable_coinage"), ("xn--abc", None, None),
             ("aaaab", None, None), ("a--b", None, None), ("12345", None, None), ("bcdfghjk", None, None)]
    df = names.classify_name(spark.createDataFrame([(n, s) for n, s, _ in given], "name string, segments array<string>"))
    got = {r["name"]: r for r in df.collect()}
    assert [got[n]["path"] for n, _, _ in given] == [p for _, _, p in given]
    assert [got[n]["reason"] for n in ("xn--abc", "aaaab", "a--b", "12345", "bcdfghjk")] == ["encoded_idn", "repeated_characters", "hyphens", "numeric_only", "not_readable"]


def test_root_spans(spark):
    spans = column(spark, ["convert-converter", "generatormaker", "xn--maker", "none", None], matching.root_spans)
    assert [[(s["root"], s["start"], s["end"]) for s in x] for x in spans] == [
        [("convert", 0, 7), ("converter", 8, 17)], [("generator", 0, 9), ("maker", 9, 14)], [], [], []]
    df = matching.root_spans_whole(spark.createDataFrame([("Logo Maker, makers éconvert",)], "t string"), "t")
    assert [(s["root"], s["start"], s["end"]) for s in df.first()["spans"]] == [("maker", 5, 10)]


def refill(limit, shares, available):
    """Cap at what is there, then one more for each group in turn."""
    out = [min(q, a) for (_, _, q), a in zip(sampling.quotas(limit, shares), available, strict=True)]
    while sum(out) < limit and any(o < a for o, a in zip(out, available, strict=True)):
        for i, a in enumerate(available):
            if out[i] < a and sum(out) < limit:
                out[i] += 1
    return out


@pytest.mark.parametrize("limit,available", [(10, (9, 9, 9, 9)), (40, (1, 2, 20, 20)), (7, (0, 0, 3, 1)), (12, (3, 0, 30, 1))])
def test_quota_refill(spark, limit, available):
    shares = V.CHANNELS
    rows = [(g, f"{g}-{k}") for (g, _), n in zip(shares, available, strict=True) for k in range(n)]
    got = sampling.quota_sample(spark.createDataFrame(rows, "channel string, domain string"), "channel", "domain", limit)
    counts = {r["channel"]: r["n"] for r in audit.histogram(got, "channel").collect()}
    assert [counts.get(g, 0) for g, _ in shares] == refill(limit, shares, available)
    assert sorted(r["queue_rank"] for r in got.collect()) == list(range(1, min(limit, sum(available)) + 1))


def test_round_robin(spark):
    rng = random.Random(4)
    roots = ["a", "b", "c"]
    rows = [(f"k{i}", rng.sample(roots, rng.randint(1, 3))) for i in range(40)]
    got = sampling.root_round_robin(spark.createDataFrame(rows, "domain string, roots array<string>"), roots, "domain", 15).collect()
    import hashlib

    order = sorted(rows, key=lambda r: hashlib.sha256(f"{T.SEED}\0{r[0]}".encode()).hexdigest())
    want, seen = [], set()
    while len(want) < 15:
        for root in roots:
            k = next((d for d, rs in order if root in rs and d not in seen), None)
            if k and len(want) < 15:
                seen.add(k)
                want.append((k, root))
    assert [(r["key"], r["sampling_root"]) for r in sorted(got, key=lambda r: r["queue_rank"])] == want


HTML = """<html><head><title>A &amp; B</title><meta name="Description" content=" first "><meta name=description content=second><meta property="og:description" content="og"></head>
<body><h1>Visible</h1><div hidden><h1>Hidden</h1>secret</div><div style="display: none">no</div><svg>no</svg><p aria-hidden=true>no</p><br>Text<img src=x> here<script>var x</script></body></html>"""


def test_page_fields():
    f = pages.read_fields(HTML)
    assert f == {"title": "A & B", "description": "first", "og_description": "og", "h1": ["Visible"], "visible_text": "Visible Text here"}
    many = pages.read_fields("".join(f"<h1>t{i}</h1>" for i in range(14)))
    assert len(many["h1"]) == 10
    assert pages.read_fields(None)["title"] == ""


def test_decoding():
    assert pages.decode_body("é".encode("cp1252"), "text/html; charset=windows-1252") == "é"
    assert pages.decode_body("中文".encode("gb18030")) == "中文"
    assert pages.decode_body(b'<meta charset="latin-1">\xe9') == '<meta charset="latin-1">é'
    assert pages.decode_body(b"\xef\xbb\xbfx") == "x" and pages.decode_body(None) is None


@pytest.mark.parametrize(
    "title,h1,text,html,want",
    [
        ("Just a moment...", [], "x" * 900, "", "challenge"),
        ("404 - Page not found", [], "x" * 900, "", "soft_404"),
        ("This domain is for sale", [], "x" * 1199, "", "parking_page"),
        ("This domain is for sale", [], "x" * 1200, "", "html_with_content"),
        ("Coming soon!", [], "x" * 799, "", "placeholder_page"),
        ("Coming soon!", [], "x" * 800, "", "html_with_content"),
        ("T", [], "x" * 159, "<script>", "javascript_or_thin"),
        ("T", [], "x" * 159, "", "thin_or_empty"),
        ("", [" "], "x" * 160, "", "missing_keyword_evidence"),
        ("T", [], "x" * 160, "", "html_with_content"),
    ],
)
def test_classify(spark, title, h1, text, html, want):
    df = spark.createDataFrame([(title, h1, text, html)], "t string, h array<string>, x string, html string")
    _, reason = pages.classify(F.col("t"), F.col("h"), F.lit(""), F.col("x"), F.col("html"))
    assert df.select(reason.alias("r")).first()["r"] == want


def test_targets_and_robots():
    ok = ["https://example.com/a", "http://example.com:80/"]
    bad = ["ftp://example.com", "https://u:p@example.com/", "https://127.0.0.1/", "http://10.0.0.1", "https://example.com:8443/", "https://[::1]/", "https://[::ffff:10.0.0.1]/", "https://localhost/", None]
    assert all(map(pages.public_target, ok)) and not any(map(pages.public_target, bad))
    assert pages.robots_decision("User-agent: *\nDisallow: /x", "/x/1") == "disallow"
    assert pages.robots_decision("User-agent: *\nDisallow: /x", "/y") == "allow"
    assert pages.robots_decision("User-agent: *\nDisallow: /*.pdf", "/y") == "defer"
    assert pages.robots_decision("<html>", "/") == "defer" and pages.robots_decision("User-agent: *\nCrawl-delay: 9", "/") == "defer"
    assert pages.robots_decision(None, "/") == "allow"


def test_registration(spark):
    ts = "2026-09-01 00:00:00"
    df = spark.sql(f"""SELECT * FROM VALUES (1, array(named_struct('action','registration','at',timestamp'2026-08-20'), named_struct('action','registration','at',timestamp'2020-01-01'))),
      (2, array(named_struct('action','registration','at',timestamp'2026-08-20'))), (3, array(named_struct('action','registration','at',timestamp'2027-01-01'))),
      (4, array(named_struct('action','last changed','at',timestamp'2026-08-20'))) AS t(i, e)""")
    status, _ = pages.registration(F.col("e"), F.lit(ts).cast("timestamp"))
    assert [r[0] for r in df.orderBy("i").select(status).collect()] == ["verified_old", "verified_recent", "unknown", "unknown"]


def grown(spark, values):
    df = spark.createDataFrame([(values,)], "values array<bigint>").withColumn("start", F.lit("2026-01-01").cast("date"))
    return df


@pytest.mark.parametrize(
    "values,want",
    [
        ([0] * 30, "below_reporting_threshold"),
        ([1] * 29, "incomplete_or_non_daily"),
        ([1] * 23 + [2] * 7, "rapid_growth"),
        ([10] * 23 + [19] * 7, "growth_rule_not_met"),
        ([0] * 23 + [5] * 7, "zero_baseline_emerging"),
        ([1] * 23 + [0, 0, 0, 9, 9, 9, 9], "growth_rule_not_met"),
        ([1] * 23 + [2, 2, 2, 2, 2, 2, 8], "rapid_growth"),
        ([1] * 23 + [2, 2, 2, 2, 2, 2, 9], "growth_rule_not_met"),
    ],
)
def test_growth(spark, values, want):
    assert series.growth_rule(grown(spark, values)).first()["status"] == want


@pytest.mark.parametrize(
    "values,want",
    [([0] * 30, "zero"), ([0] * 26 + [1] * 4, "sparse"), ([0] * 16 + [5] * 7 + [8] * 7, "emerging"), ([5] * 23 + [8] * 7, "rising"), ([8] * 23 + [4] * 7, "cooling"), ([5] * 30, "other")],
)
def test_persistence(spark, values, want):
    assert series.persistence(grown(spark, values)).first()["status"] == want


def test_background(spark):
    def run(points):
        df = spark.createDataFrame([("k", d, v, p) for d, v, p in points], "k string, d string, value int, partial boolean").withColumn("day", F.to_date("d")).drop("d")
        return series.background(df, ["k"], F.lit("2026-06-01").cast("date"), F.lit("2026-01-01").cast("date"), F.lit("2026-06-30").cast("date")).first()["status"]

    import datetime

    weeks = [(datetime.date(2026, 1, 4) + datetime.timedelta(days=7 * i)).isoformat() for i in range(26)]
    assert run([(w, 0, False) for w in weeks]) == "background_below_threshold"
    assert run([(w, int(i == 3), False) for i, w in enumerate(weeks)]) == "earlier_signal_requires_review"
    straddling = max(i for i, w in enumerate(weeks) if w < "2026-06-01")
    assert run([(w, int(i == straddling), False) for i, w in enumerate(weeks)]) == "no_earlier_reported_signal"
    assert run([(w, 0, False) for i, w in enumerate(weeks) if i != 5]) == "background_incomplete"
    late = [((datetime.date(2026, 1, 11) + datetime.timedelta(days=7 * i)).isoformat(), 0, False) for i in range(25)]
    assert run(late) == "background_incomplete"


def phrases_of(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["p"] for r in df.select("i", column.alias("p")).orderBy("i").collect()]


def test_root_phrases(spark):
    texts = [
        "Font Detector From Image | Home", "The best logo maker", "welcome to our site", None, "Online PDF Editor", "", "maker",
        "logo\u00a0 maker", "Try it. The free c++ code-formatter's viewer, see x.com viewer", "a viewer of our easy-to-use 3d model viewer - online",
        "one two three four five six seven eight viewer", "\x1clogo\x1c-\x1cmaker", "Kölner logo maker", "page sample for all the new users here", "\u212aelvin (k) converter",
        "online", "maker maker maker", "maker online", "x " * 3000 + "maker", "LOGO MAKER|logo maker. logo  maker",
    ]
    got = phrases_of(spark, texts, phrases.root_phrases(F.col("t"), V.ROOTS))
    assert got[0] == ["font detector", "font detector from image"]
    assert got[1] == ["logo maker"] and got[2] == got[3] == got[5] == got[6] == got[11] == []
    assert got[4] == ["online pdf editor", "pdf editor"] or "online pdf editor" in got[4]
    assert got[7] == ["logo maker"]
    assert got[8] == ["c++ code-formatter's viewer"]  # what names an address goes; code-formatter's is one word and no root
    assert got[9] == ["easy-to-use 3d model viewer", "viewer of our easy-to-use 3d model viewer"]
    assert got[10] == ["four five six seven eight viewer"]
    assert got[12] == [] and got[13] == ["page sample for all"]
    assert got[14] == ["elvin (k) converter"]
    assert got[15] == got[16] == got[17] == []
    assert got[18] == ["x x x x x maker"]
    assert got[19] == ["logo maker"]


def test_short_segments_and_their_union(spark):
    texts = [
        "Welcome | Fast PDF tool! see example.com now; 日本語のツール。無料で使える！x", "Contact Us: a_b c\u00b2 \u2022 logo maker", "one", None, "w " * 11 + "| " + "y" * 121,
        "ab cd\u0085 - ef gh", "www.shop page | a https: //x, http://x y | a.comet tail | b.com!tail",
    ]
    got = phrases_of(spark, texts, phrases.short_segments(F.col("t")))
    assert got[0] == ["Fast PDF tool", "日本語のツール", "無料で使える"]
    assert got[1] == ["a_b c²", "logo maker"] and got[2] == got[3] == got[4] == []
    assert got[5] == ["ab cd", "ef gh"] and got[6] == ["a https", "//x, http", "//x y", "a.comet tail"]
    both = phrases_of(spark, ["Free Logo Maker | logo maker", "Logo Maker", None], phrases.literal_phrases(F.col("t"), V.ROOTS))
    span, short = phrases.ROOT_SPAN, phrases.SHORT_SEGMENT
    assert [tuple(x) for x in both[0]] == [("logo maker", short), ("Free Logo Maker", short)]
    assert [tuple(x) for x in both[1]] == [("logo maker", span), ("Logo Maker", short)] and both[2] == []


def test_fragments(spark):
    df = spark.createDataFrame([(1, "Home", ["Pitch Deck Maker", "PITCH deck maker"], "A first one. A second one! " + "x" * 200)], "k int, title string, h1 array<string>, description string")
    got = phrases.page_fragments(df, "k", [("h1", "h1"), ("title", "title"), ("description", "description")]).orderBy("rank").collect()
    assert [(r["field"], r["phrase"]) for r in got] == [("h1", "Pitch Deck Maker"), ("description", "A first one."), ("description", "A second one!")]


def test_gate_and_coverage(spark):
    stage = series.stage_gate
    rows = [(None, None, None), (False, None, None), (True, None, None), (True, True, None), (True, True, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a boolean, b boolean, c boolean")
    assert [r[0] for r in df.orderBy("i").select(stage(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["chart", "ended_at_chart", "background", "repeat", "done"]
    caps = spark.createDataFrame([(1, 1, ["a", "b"]), (2, 2, ["a"]), (3, 3, ["c"])], "capture int, at int, terms array<string>")
    assert audit.capture_coverage(caps).first().asDict() == {"multi_terms": 2, "single_terms": 2, "recheck_terms": 1, "comparison_only": 1}


def test_empty_tables(spark):
    e = spark.createDataFrame([], "user_id bigint, ts timestamp")
    assert series.growth_rule(series.daily_series(e, ["user_id"])).count() == 0
    n = spark.createDataFrame([], "channel string, domain string")
    assert sampling.quota_sample(n, "channel", "domain", 5).count() == 0
    assert sampling.root_round_robin(spark.createDataFrame([], "domain string, roots array<string>"), ["a"], "domain", 3).count() == 0


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/2026-02-03.txt").write_bytes(b"\xef\xbb\xbfA.com\n\nbad\xff\nb.com\r\n")
    lines = readers.read_lines(spark, str(tmp_path / "in")).orderBy("source_line").collect()
    assert [(r["source_line"], r["raw"], r["reason_code"]) for r in lines] == [(1, "A.com", None), (2, "", None), (3, None, "invalid_utf8"), (4, "b.com", None)]
    assert str(lines[0]["source_date"]) == "2026-02-03"
    days = readers.day_tokens(spark, "2026-01-30", "2026-02-02")
    assert days.count() == 4
    good = "Category: All\n\nDay,logo maker: (United States)\n" + "\n".join(f"2026-01-{d:02d},{d}" for d in range(1, 31))
    assert readers.parse_export(good, "logo maker")[0] == "" and readers.parse_export(good, "logo")[0] == "term"
    assert readers.parse_export(good.replace(",7", ",101"), "logo maker")[0] == "value" and readers.parse_export("x", "y")[0] == "heading"
    df = spark.createDataFrame([("a", "=1"), ("b", "x")], "g string, t string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert "'=1" in "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    sinks.write_new(df, str(tmp_path / "new"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_new(df, str(tmp_path / "new"))
    sinks.write_by_group(df, "g", "t", str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("g=*")) == ["g=a", "g=b"]
    red = sinks.redacted(df, "g", ["t"], spark.createDataFrame([("a",)], "g string")).collect()
    assert {r["t"] for r in red} == {None, "x"} and any(r["g"].startswith("alias-") for r in red)
    assert sinks.markdown_table(df.orderBy("g")).splitlines()[2] == "| a | =1 |"
    assert readers.read_json_lines(spark, _jsonl(tmp_path), "a int", "any").count() == 2
    assert [r["a"] for r in readers.read_json_lines(spark, _jsonl(tmp_path), "a int", "tail").collect() if r["_corrupt_record"] is not None] == [None]
    servers = readers.registry_servers(spark.createDataFrame([([[["com", "net"], ["https://r/"]]],)], "services array<array<array<string>>>"))
    assert {(r["tld"], r["server"]) for r in servers.collect()} == {("com", "https://r/"), ("net", "https://r/")}


def _jsonl(tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n{"a": 2}\n{"a"')
    return str(p)


def test_runs_by_segments(spark):
    """Runs across segments are those of one pass."""
    rng = random.Random(8)
    rows = [(k, i // 4, i, rng.random() < 0.7) for k in ("a", "b", None) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, day int, i int, bad boolean").where("k is not null")
    order, hit = ["day", "i"], F.col("bad")
    plain = {(r["k"], r["i"]): r["run_length"] for r in sampling.runs(df, ["k"], order, hit).collect()}
    cut = {(r["k"], r["i"]): r["run_length"] for r in sampling.runs(df, ["k"], order, hit, F.col("day")).collect()}
    want, run, last = {}, 0, None
    for k, _, i, bad in sorted((r for r in rows if r[0]), key=lambda r: (r[0], r[2])):
        run = (run + 1 if k == last else 1) if bad else 0
        last, want[(k, i)] = k, run
    assert plain == want and cut == want


def test_probe_verdicts(spark):
    """P6 with the patterns of the monthly probe."""
    body, long = "x" * 900, "words enough to say what this page is for, and more"
    rows = [
        (1, "This domain is available", [], long, body), (2, "A shop", ["Domain has expired"], long, body), (3, "Website is coming soon", [], long, body),
        (4, "", [], long, "Buy this domain " + body), (5, "A shop", [], long, "Buy this domain " + body), (6, "WWW.a.example", [], long, "future home of " + body),
        (7, "Please wait", [], long, body), (8, "404 error", [], long, body), (9, "A shop", ["The page was not found"], long, body), (10, "即将上线！", [], long, body),
        (11, "A shop", ["登录"], "short", body), (12, "A shop", ["Garden tools"], "short", body), (13, "A shop", [], long, "thin"), (14, "Coming soon...", [], long, body),
    ]
    df = spark.createDataFrame(rows, "i int, title string, h1 array<string>, description string, visible_text string")
    v = pages.verdict(F.col("title"), F.col("h1"), F.col("description"), F.col("visible_text"), F.lit("verified_recent"), F.lit(False), F.lit("a.example"))
    got = {r["i"]: r["v"] for r in df.select("i", v.alias("v")).collect()}
    parked, wall = {1, 2, 3, 4, 6, 10, 14}, {7, 8, 9}
    assert got == {i: "parked" if i in parked else "unavailable" if i in wall else "thin" if i in (11, 13) else "candidate" for i in range(1, 15)}
