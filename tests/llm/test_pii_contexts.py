"""What the bootstrap of personal data learns from contexts, however long or odd."""

from tagmatch.llm import pii

CALLS = [(i, f"you can call +1 (555) 555-{1000 + i} today") for i in range(300)]


def found(spark, rows):
    """{doc_id: spans beside the base ones, as text}."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {}
    for row in pii.with_pii(docs).collect():
        base = {tuple(s) for s in row.base_spans}
        extra = [tuple(s) for s in row.spans if tuple(s) not in base]
        out[row.doc_id] = [(kind, row.text[start:end]) for kind, start, end in extra]
    return out


def test_very_long_and_odd_contexts_and_tokens(spark):
    """In one table, behind a pattern of many seeds."""
    rows, want = list(CALLS), {}

    def add(text, *extra):
        rows.append((len(rows), text))
        want[len(rows) - 1] = [("phone", token) for token in extra]

    for mark in ("7", ".", "(", "7.", "7 ", " ", "é", "+", "-7"):
        token = (mark * 100_000)[:100_000]
        for text in (token, token + "9"):
            rows.append((len(rows), f"you can call {text} today"))
            if mark == "7":
                want[len(rows) - 1] = [("phone", text)]
    for gap in (" ", " " * 125, "\n" * 3000, " \t\r "):
        add(f"you can call{gap}555-9011{gap}today", "555-9011")
    add("x" * 200_000 + " can call 555-9012 " + "-" * 200_000, "555-9012")
    add("you can call 555\u20289013 today", "555\u20289013")
    add("you can call (555-9014\u2028 today", "555-9014")
    got = found(spark, rows)
    assert all(got[i] == spans for i, spans in want.items())
    assert not any(got[i] for i in range(len(CALLS)))


def test_a_token_before_is_a_word_of_the_context(spark):
    rows = [(i, f"room 5, call +1 (555) 555-{1000 + i} now") for i in range(20)]
    rows.append((100, "room 7, call 555-9012 now"))
    assert found(spark, rows)[100] == [("phone", "555-9012")]


def test_identifiers_two_hops_away_are_found(spark):
    """Learned numbers make a second context known, which no seed occurs in."""
    learned = [f"555-20{i}" for i in range(10, 20)]
    rows = CALLS + [(100 + n, f"you can call {number} today") for n, number in enumerate(learned)]
    rows += [(200 + n, f"our hot line {number} again") for n, number in enumerate(learned)]
    rows += [(300, "our hot line 555-7777 again"), (301, "some cold row 555-7777 then")]
    got = found(spark, rows)
    assert got[300] == [("phone", "555-7777")]
    assert got[200] == [("phone", "555-2010")]
    assert got[301] == []
