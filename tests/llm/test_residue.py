import pytest

from linkspan.llm.residue import examine, is_filler, key_of, residue, slots_of

DOC = "doc_id long, url string, host string, text string, keys string"


@pytest.mark.parametrize("line,n", [("Dear {{ name }}, hi", 1), ("%%A%% in [[b]]", 2), ("${x} <%= y %> @@z@@ #CITY# __NAME__", 5), ("[Your name] [INSERT X HERE] XX_A_XX {a_b} *|FNAME|*", 4), ("price $5 {x", 0), ("plain [sic] text #1", 0)])
def test_slots(line, n):
    masked, styles = slots_of(line)
    assert len(styles) == n and ("□" in masked) == bool(n)


def test_keys_and_filler():
    assert key_of("404 – Page NOT found.") == key_of("405 - page not found") and key_of("TBD TBD TBD") == "tbd"
    assert is_filler("lorem ipsum dolor sit amet".split()) and is_filler(["test", "asdf"]) and not is_filler("sit down at the table".split()) and not is_filler([])


def test_examine_of_nothing_and_much():
    assert examine(None, None)["keys"] == [] and examine("", " \n ")["keys"] == []
    assert examine("http://x/a", "word and more. " * 50_000)["long"]


def corpus():
    docs, n = [], 0
    words = ["ferry", "mill", "garden", "lantern", "choir", "bridge", "kettle", "harbour", "meadow", "ledger"]
    for h in range(12):
        host = f"host{h}.example"
        for k in range(4):
            a, b, c = words[(h + k) % 10], words[(h * 3 + k) % 10], words[(h + 7 * k) % 10]
            body = f"Home | News\nThe {a} of {host[:5]}{k} and Vero{'abcdefghijkl'[h]}{k}n\nEvery {b} in Ruko{'abcdefghijkl'[h]}{'wxyz'[k]} paints the {c} at noon.\nNobody in Sila{'abcdefghijkl'[h]}{'wxyz'[k]} sold a {a} that year.\nAll rights reserved {host}"
            docs.append((n, f"http://{host}/p-{n}", host, body, "x"))
            n += 1
        letter = "abcdefghijkl"[h]
        for text in (f"{letter}ite.example\nPage not found. It was moved.", f"Loading {letter}\nThis shop needs scripts to be on.\nPage not found. It was moved."):
            docs.append((n, f"http://{host}/p-{n}", host, f"Home | News\n{text}\nAll rights reserved {letter}os", "x"))
            n += 1
    return docs


def test_residue(spark):
    docs = corpus()
    want = {d[0] for d in docs if "not found" in d[3]}
    real = "Home | News\nA long story of the mill\nThe miller of Harrowgate sold the wheel in May.\nHis daughter kept the ledger until the flood.\n"
    more = {
        500: (real + "Dear {first_name}, thank you for visiting %%CITY%%.", True),
        501: (real + "In the workshop we explain why a template writes {{ name }} in double braces and what the engine puts in its place.", False),
        502: ("Home | News\nThe bridge of Kilorin\nLorem ipsum dolor sit amet elit sed.\nTBD TBD TBD", True),
        503: (real + "Lorem ipsum dolor sit amet elit sed.", False),
        504: ("Home | News\nPage not found. It was moved.\nYet the archive of Denmore keeps a copy of the letter.", False),
        505: (None, False), 506: ("", False), 507: (" \n", False),
        508: ("Price: undefined | Stock: NaN", True),
    }
    docs += [(k, None, None if k % 2 else "h", t, "x") for k, (t, _) in more.items()]
    docs.append(docs[0])
    got = [r["doc_id"] for r in residue(spark.createDataFrame(docs, DOC)).collect()]
    assert len(got) == len(set(got)) and set(got) == want | {k for k, (_, case) in more.items() if case}


def test_mirrors_with_menus_and_footers(spark):
    story = "The wheel of the old mill\nMay brought rain.\nThe ledger was lost.\nNobody asked."
    docs = [(i, f"http://h{i}/x", f"h{i}", f"Menu {'abcdefghij'[i % 10] * 4} of pages\n{story}\nFooter {'klmnopqrst'[i // 10] * 3} line", "x") for i in range(80)]
    assert residue(spark.createDataFrame(docs, DOC)).count() == 0


def test_mirrors_and_empty(spark):
    page = "Home | News\nThe same story everywhere\nThe miller of Harrowgate sold the wheel in May.\nHis daughter kept the ledger until the flood."
    docs = [(i, f"http://h{i}/x", f"h{i}", page, "x") for i in range(40)]
    assert residue(spark.createDataFrame(docs, DOC)).count() == 0
    assert residue(spark.createDataFrame([], DOC)).count() == 0


@pytest.mark.parametrize("url,line,echoes", [("http://h/a/mill-7", "The mill", True), ("http://h/a/mill-7?page=2#more", "Show this page", False), ("http://h/a/p?ref=x/page", "Show this page", False), ("http://mill.example", "The mill", False), ("http://h/a/page-7", "Page not found", False), ("http://h/a/lorem", "Lorem ipsum dolor sit", False)])
def test_echo_of_the_slug(url, line, echoes):
    assert bool(examine(url, line)["echoes"]) == echoes and not examine(None, line)["echoes"]


def test_slug_in_messages_and_copies(spark):
    docs = corpus()
    gone = "Home | News\nPage not found. It was moved.\nAll rights reserved {}os"
    want = {d[0] for d in docs if "not found" in d[3]}
    docs += [(600, "http://n/sobujo-1?page=2", "n", gone.format("n"), "x"), (601, "http://n/sobujo-2", "n", gone.format("n"), "x")]
    docs += [(602, "http://n/moved-3", "n", gone.format("n"), "x"), (603, "http://n/news", "n", gone.format("n"), "x"), (604, "http://n/rights", "n", gone.format("n"), "x")]
    docs += [(605, "http://n/kilorin-4", "n", "Home | News\nThe bridge of Kilorin\nPage not found. It was moved.\nAll rights reserved nos", "x")]
    got = {r["doc_id"] for r in residue(spark.createDataFrame(docs, DOC)).collect()}
    assert got == want | {600, 601, 602, 603, 604}


def test_one_page_of_a_copy_bears_the_slug(spark):
    text = "Home | News\nThe bridge of Kilorin\nPage not found. It was moved."
    docs = corpus() + [(700, "http://n/kilorin", "n", text, "x"), (701, "http://n/other", "n", text, "x")]
    got = {r["doc_id"] for r in residue(spark.createDataFrame(docs, DOC)).collect()}
    assert 701 in got and 700 not in got


def test_long_messages_and_slugs_in_them(spark):
    """A sentence of 251 characters is a message like any other, and a slug that names its words doesn't make it content."""
    long = ("The page could not be found on this server, it may have been moved, renamed or deleted by its owner, " * 3)[:250] + "."
    docs = corpus() + [(800 + i, f"http://q{i}.example/page-found", f"q{i}", f"{'bcdfghjklmnpqrstvwxz'[i % 20] * 3}{'aeiou'[i // 20]}\n{long}", "x") for i in range(40)]
    docs += [(900, "http://own.example/x", "own", "The story of the kiln, told at length " * 9 + ", ends with rain in the valley of Ormel.", "x")]
    got = {r["doc_id"] for r in residue(spark.createDataFrame(docs, DOC)).collect()}
    assert {800 + i for i in range(40)} <= got and 900 not in got


def test_pages_are_told_apart_by_128_bits():
    assert len(examine("u", "a")["copy"]) == 16 and examine("u", "a")["copy"] != examine("u", "b")["copy"]
