"""Pages, scores, texts and payloads, each with the odd cases."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import html as H
from tidemark.functions import payload as P
from tidemark.functions import scores as S
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import extract as E

ROOT = "https://www.example.org"


def value(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


def text_fn(spark, fn, text):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(fn(F.col("x"))).first()[0]


# Reading pages -----------------------------------------------------------------------------


def test_any_markup_is_read():
    """Kept blocks hold what they hold in the whole page, however broken it is."""
    rnd = random.Random(1)
    for _ in range(5000):
        html = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 9)))
        page, blocks = H.read_page(html), H.read_page(html, {"p": "a"})
        whole = [n.text() for n in page.find_all("p", css="a")]
        assert [n.text() for n in blocks.find_all("p", css="a")] == whole, html


def test_stray_end_tags_take_no_time():
    page = H.read_page("<i>" * 50_000 + "</b>" * 50_000 + "x")
    assert page.text() == "x"


PIECES = [
    "<", ">", '"', "'", "/", "&amp;", "&copy", "<!--", "-->", "<!-- x -->", "<script>", "</script>", "<b>", "</b>",
    "<br/>", '<a href="x&y=1">', "</a>", " ", "x", "=", "<p class=a>", "<i id='q'>", "<title>", "</title>",
    "<!DOCTYPE html>", "-", "<style>", "</style>", "<textarea>", "<P A='1' B>", '<img alt="a>b">', "</p >", "<svg/>",
]


PLAIN = [
    "<p class='a'>", "<P CLASS=\"a\" b>", "</p>", "</P >", "<p>", "<br>", "<br/>", "<img src='x' alt=\"it's\" />", "<svg/>", "<h1>", "</h1>",
    "x", " ", "\n", ">", "'", '"', "&amp;", "&copy", "&", "\0", "<!-- x -->", "<!DOCTYPE html>", "<a href='?a=1'>", "</a>", "<i a='1' A='2'\t>",
]


def tree(node):
    return node.tag, node.attrs, [c if isinstance(c, str) else tree(c) for c in node.children]


def test_plain_markup_needs_no_parser(monkeypatch):
    """Plain pages are read without the tolerant parser, as other pages cannot be, to the tree that it makes."""
    rnd, blocks, read = random.Random(2), H._Blocks, []

    class Counted(blocks):
        def __init__(self, wanted):
            super().__init__(wanted)
            read.append(wanted)

    monkeypatch.setattr(H, "_Blocks", Counted)
    for k in range(6000):
        html = "".join(rnd.choice(PLAIN if k % 2 else PLAIN + PIECES) for _ in range(rnd.randint(1, 12)))
        for wanted in (None, {"p": "a"}, {"h1": None, "p": "a"}):
            del read[:]
            page = H.read_page(html, wanted)
            assert not read or k % 2 == 0, html
            reader = blocks(wanted)
            reader.feed(html)
            reader.close()
            assert tree(page) == tree(reader.page), html


def test_find_stays_inside_the_element():
    page = H.read_page("<div class='a b'><p>1<p>2</div><p>3</p><div class='ab'><p>4</p></div>")
    first = page.find("div", css="a")
    assert [p.text() for p in first.find_all("p")] == ["12", "2"]
    assert page.find("div", css="ab").find("a", "p").text() == "4"
    assert page.find("table") is None
    assert H.read_page("<p>1<ul class='events'>2</ul>3", {"ul": "events"}).text() == "2"


# Calendar pages ----------------------------------------------------------------------------


def event(inner="", href="/en/tournaments/doha/451/overview", venue="Doha, Qatar |", badge='alt=" 250 "', cta="", links=""):
    return (
        f'<ul class="events"><li><div class="tournament-info"><img class="events_banner" {badge}>'
        f'<a class="tournament__profile" href="{href}"><span class="name"> Doha Open\n</span>'
        f'<span class="venue">{venue}</span>{inner}</a></div><div class="cta-holder">{cta}</div>'
        f'<div class="non-live-cta">{links}</div></li><li>second</li></ul>'
    )


def calendar(spark, *blocks):
    html = "<html><p>x<div>" + "".join(blocks) + "</html>"
    pages = spark.createDataFrame([(1, 2024, html)], "page_id int, year int, html string")
    return [r.asDict() for r in E.calendar_records(pages, ROOT).orderBy("position").collect()]


def test_calendar_record(spark):
    cta = (
        "<dl class='winner'><dt>Singles Winner</dt><dd><a> A </a></dd></dl>"
        "<dl class='winner'><dt>DOUBLES</dt><dd><a>B</a></dd><dd> C </dd><dd> </dd></dl>"
        "<dl class='winner'><dd>no label</dd></dl><dl><dt>Singles</dt><dd>not a winner list</dd></dl>"
    )
    links = '<a class="results" href="/en/scores/archive/doha/451/results">Results</a>'
    (got,) = calendar(spark, event('<span class="Date"> 1-7 Jan </span>', cta=cta, links=links))
    assert got == {
        "page_id": 1, "position": 0, "year": 2024, "tournament": "Doha Open", "tournament_id": "451",
        "category": "250", "city": "Doha", "country": "Qatar", "dates": "1-7 Jan", "singles_winner": "A",
        "doubles_winner": ["B", "C"], "url": f"{ROOT}/en/scores/archive/doha/451/results",
    }


def test_calendar_defaults_and_unreadable_blocks(spark):
    got = calendar(
        spark,
        event(href="/x/451", venue="Doha", badge=""),
        event(venue="A, B, C |", cta="<dl class='winner'><dt>Team winner</dt><dd>T</dd></dl>"),
        '<ul class="events"></ul>',
        '<ul class="events"><li><div class="tournament-info"><a class="tournament__profile">no name</a></div></li></ul>',
        '<ul class="events"><li><div class="tournament-info"></div></li></ul>',
    )
    assert [(g["tournament"], g["tournament_id"], g["category"], g["city"], g["country"]) for g in got] == [
        ("Doha Open", None, "Other", "Doha", "Unknown"), ("Doha Open", "451", "250", "A", "B, C"),
        (None, None, "Other", "", "Unknown"),
    ]
    assert [g["singles_winner"] for g in got] == [None, "T", None]
    assert [g["doubles_winner"] for g in got] == [None] * 3
    assert [g["url"] for g in got] == [None] * 3


# Results pages -----------------------------------------------------------------------------


def player(name, href="/en/players/x/a1/overview", seed=""):
    link = f'<a href="{href}">{name}</a>' if href is not None else f"<p>{name}</p>"
    return f'<div class="name">{link}{seed}</div>'


def block(*sets):
    items = "".join(f'<div class="score-item">{"".join(f"<span>{x}</span>" for x in s)}</div>' for s in sets)
    return f'<div class="scores">{items}</div>'


FLAG = '<svg><use href="/f.svg#flag-esp"></use></svg>'


def match(players, flags=FLAG * 2, scores="", heading="<strong>Round of 16 - 01:10</strong>", cta=""):
    return f'<div class="match">{heading}{"".join(players)}{flags}{scores}<div class="match-cta">{cta}</div></div>'


def results(spark, *blocks):
    html = '<div class="atp_accordion-item">' + "".join(blocks) + "</div><div class='match'>outside</div>"
    pages = spark.createDataFrame(
        [(1, 2024, "T", "451", html)],
        "page_id int, year int, tournament_name string, tournament_id string, html string",
    )
    return [r.asDict() for r in E.match_records(pages, ROOT).orderBy("position").collect()]


def test_singles(spark):
    (got,) = results(spark, match(
        [player(" Ann\n  Lee ", seed="<span>(3)</span>"), player("Bo", "/en/players/y/b2/overview")],
        scores=block(["6"], [], ["7"]) + block(["4"], ["6", "5"], ["9"], ["0"]),
        cta="<a href='/h2h'>H2H</a><a href='/en/stats/ms001'>Match Stats</a>",
    ))
    assert got == {
        "page_id": 1, "position": 0, "round": "Round Of 16", "player1_name": "Ann Lee", "player1_id": "a1",
        "player1_seed": "3", "player1_nation": "esp", "player2_name": "Bo", "player2_id": "b2",
        "player2_seed": "", "player2_nation": "esp", "score": "64 76(5)", "url": f"{ROOT}/en/stats/ms001",
        "match_id": "ms001", "year": 2024, "tournament_name": "T", "tournament_id": "451",
    }


def test_doubles(spark):
    four = [player(n, f"/p/x/{n}/o") for n in "ABCD"]
    seeded = [player(n, f"/p/x/{n}/o", "<span>(2)</span>") for n in "ABCD"]
    got = results(
        spark,
        match(four, FLAG * 4),
        match(seeded, FLAG * 2),
        match([seeded[0], *four[1:]]),                       # only the first has a seed
        match([*four[:3], player("D", None)]),               # a partner without an address
        match(four[:3]),                                     # three players
        match(four, FLAG * 3 + "<svg></svg>"),               # a flag without an image
    )
    assert [(g["position"], g["player1_name"], g["player2_id"], g["player1_seed"], g["player1_nation"]) for g in got] == [
        (0, "A, B", "C, D", "", "esp, esp"), (1, "A, B", "C, D", "2", ""), (4, "", "", "", ""),
        (5, "A, B", "C, D", "", "-"),
    ]


def test_odd_matches(spark):
    two = [player("A"), player("B")]
    got = results(
        spark,
        match(two, flags="", heading=""),                                    # no flag, no heading
        match(two, flags="<svg></svg>" + FLAG),                              # no image in one flag
        match(two, flags='<svg><use href="/f.svg"></use></svg>' + FLAG),     # an image without a code
        match([player("A", None), player("B")]),                             # a name without an address
        match([player("A", "nothing"), player("B")]),                        # an address without an id
        match(['<div class="name"><a href="/p/a/b"></a></div>', player("B")]),   # an empty name
        match(two, cta="<a>Stats</a>"),                                      # statistics without an address
        match(two, scores=block(["6"])),                                     # one score block
        match(two, scores=block(["6"], ["1", "2", "3"]) + block(["4"], ["2"])),  # three texts in a set
        match(two, scores=block(["1", "2", "3"]) + block(["4"])),            # the same in the first set
        match(two, cta="<a href='/x'><b>Match Stats</b></a>"),               # nested text
    )
    kept = {g["position"]: g for g in got}
    assert sorted(kept) == [0, 1, 2, 3, 7, 8, 10]
    assert (kept[0]["round"], kept[0]["player1_nation"]) == ("Unknown Round", "")
    assert (kept[1]["player1_nation"], kept[1]["player2_nation"]) == ("-", "esp")
    assert (kept[2]["player1_nation"], kept[2]["player2_nation"]) == ("-", "-")
    assert kept[3]["player1_id"] == "" and kept[0]["match_id"] == "" and kept[0]["url"] == ""
    assert (kept[7]["score"], kept[8]["score"]) == ("", "64 62")
    assert kept[10]["url"] == f"{ROOT}/x"


# Expressions -------------------------------------------------------------------------------


@pytest.mark.parametrize("score, expected", [
    ("7(5)6", "76(5)"), ("76(5)", "76(5)"), ("6(1)7(2)", "67(2)(1)"), ("64", "64"), ("", ""), ("6(4", "6(4"),
])
def test_brackets_last(spark, score, expected):
    assert text_fn(spark, S.brackets_last, score) == expected


@pytest.mark.parametrize("name, expected", [
    ("Round Of 16", "R16"), ("1st Round Qualifying", "Q1"), ("First Round", "FR"), ("Quarterfinals", "QF"),
    ("Semi-Finals", "SF"), ("Final", "F"), ("Host City Finals", "Host City Finals"),
])
def test_round_short(spark, name, expected):
    assert text_fn(spark, T.round_short, name) == expected


@pytest.mark.parametrize("heading, expected", [
    ("Round of 16 - x - y", "Round Of 16"), ("Quarter-Finals", "Quarterfinals"),
    ("1st  Round\nQualifying", "1st Round Qualifying"), (None, "Unknown Round"), ("", ""),
])
def test_round_title(spark, heading, expected):
    assert text_fn(spark, T.round_title, heading) == expected


@pytest.mark.parametrize("href, expected", [
    ("/en/tournaments/doha/451/overview", "451"), ("/a/b/c/", "b"), ("/a/b", None), ("", None), (None, None),
])
def test_profile_id(spark, href, expected):
    assert text_fn(spark, U.profile_id, href) == expected


@pytest.mark.parametrize("url, expected", [
    ("https://h/en/scores/current/doha", "current"), ("/en/scores/current/doha", "current"), ("https://h/en", ""),
])
def test_path_segment(spark, url, expected):
    assert text_fn(spark, lambda c: U.path_segment(c, 4), url) == expected


def test_unknown_data_type_fails(spark):
    make = lambda strict: U.match_data_url(
        F.lit("nothing"), F.lit(2024), F.lit("1"), F.lit("ms1"), ROOT, ROOT, strict
    )
    assert value(spark, make(False)) is None
    with pytest.raises(Exception, match="unknown data type"):
        value(spark, make(True))


def test_template_without_a_value_fails():
    with pytest.raises(KeyError):
        U.fill("raw/{year}/{nothing}", year=F.lit(1))


@pytest.mark.parametrize("millis, expected", [
    (1706000000123, "#3zklelyfqb10ib$"), (1704067200000, None), (1709251199999, None),
])
def test_payload_key(spark, millis, expected):
    """Against the same arithmetic in plain Python."""
    import datetime

    def base(n, b):
        digits = ""
        while n:
            n, r = divmod(n, b)
            digits = "0123456789abcdefghijklmnopqrstuvwxyz"[r] + digits
        return digits

    at = datetime.datetime.fromtimestamp(millis / 1000, tz=datetime.timezone.utc)
    total = (at.year + int(str(at.year)[::-1])) * (at.day + int(f"{at.day:02d}"[::-1]))
    by_hand = "#" + (base(int(str(millis), 16), 36) + base(total, 24)).ljust(14, "0")[:14] + "$"
    assert value(spark, P.payload_key(F.lit(millis).cast("bigint"))) == by_hand
    assert expected in (None, by_hand)


def test_payloads_that_cannot_be_read_are_set_aside(spark):
    millis = F.lit(1706000000123).cast("bigint")
    key = P.payload_key(millis)
    encrypt = lambda text: F.base64(F.substring(F.aes_encrypt(
        F.encode(F.lit(text), "UTF-8"), F.encode(key, "UTF-8"), F.lit("CBC"), F.lit("PKCS"),
        F.encode(F.upper(key), "UTF-8")), 17, 10000))
    cases = {"good": encrypt('{"a": "é"}'), "block": encrypt('{"a": "0123456"}'), "no json": encrypt("hello"),
             "short": F.lit("AAAA"), "other": F.base64(F.encode(F.lit("x" * 32), "UTF-8"))}
    df = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), millis.alias("lastModified"), r.alias("response")) for n, r in cases.items()
    ])).alias("c")).select("c.*")
    read = {r["name"]: r["data"] for r in E.readable_payloads(df).collect()}
    assert read == {"good": '{"a": "é"}', "block": '{"a": "0123456"}'}
    assert {r["name"] for r in E.unreadable_payloads(df).collect()} == {"no json", "short", "other"}
