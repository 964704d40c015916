from collections import defaultdict

from carelayers.llm import chat


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")


def brute(rows, size=64):
    dialogues = defaultdict(list)
    for conv, turn, role, text in rows:
        key = (turn is None, turn or 0, role is None, role or "", text or "")
        dialogues[conv].append((key, role, (text or "").replace("<|", "<\\|")))
    out = []
    for conv, turns in dialogues.items():
        turns.sort(key=lambda t: t[0])
        for n in range(0, len(turns), size):
            part = turns[n : n + size]
            for side in {t[1] for t in part} - {None, "system"}:
                whole, masks = "", []
                for _, role, text in part:
                    name = "system" if role == "system" else "assistant" if role == side else f"user name={role or 'unknown'}"
                    whole += f"<|im_start|>{name}\n"
                    if role == side:
                        masks.append((len(whole), len(whole) + len(text) + 10))
                    whole += f"{text}<|im_end|>\n"
                out.append((conv, n // size, side, len(part), whole, tuple(masks)))
    return sorted(map(str, out))


def result(df, **how):
    found = chat.perspectives(df, **how).collect()
    return sorted(str((*r[:5], tuple((m.start, m.end) for m in r.masks))) for r in found)


def test_whole_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert result(turns) == brute(rows)


def test_many_parties_and_odd_rows(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "hö\n🎉"), (1, 3, "cy", None), (1, 4, None, "?"),
        (1, 2, "bob", "hö\n🎉"), (1, None, "ann", "late"), (2, 0, "system", "alone"), (3, 0, "ann", ""), (None, 0, "ann", "x"),
        (4, 0, "ann", "long " * 50_000), (4, 1, "bob", "y"),
    ]
    assert result(table(spark, rows)) == brute(rows)
    wide = table(spark, rows).selectExpr("*", "1 as place", "2 as segment", "3 as perspective", "4 as turns")
    assert result(wide) == brute(rows)
    assert result(table(spark, [])) == []


def test_long_dialogues_are_cut(spark):
    rows = [(1, i // 2, "ann" if i % 2 else "bob", f"t{i}") for i in range(300)] + [(2, 0, "ann", "same")] * 150
    assert result(table(spark, rows)) == brute(rows)
    assert result(table(spark, rows), segment_turns=7) == brute(rows, 7)


def whole_brute(rows, size=64):
    """Every segment by every speaker of the whole dialogue, after the system turns that open it."""
    dialogues = defaultdict(list)
    for conv, turn, role, text in rows:
        dialogues[conv].append(((turn is None, turn or 0, role is None, role or "", text or ""), role, text or ""))
    out = []
    for conv, turns in dialogues.items():
        turns.sort(key=lambda t: t[0])
        opened = next((i for i, t in enumerate(turns) if t[1] != "system"), len(turns))
        for n in range(0, len(turns), size):
            own = turns[n : n + size]
            for side in {t[1] for t in turns} - {None, "system"}:
                whole, masks = "", []
                for _, role, text in turns[: min(n, opened)] + own:
                    name = "system" if role == "system" else "assistant" if role == side else f"user name={role or 'unknown'}"
                    whole += f"<|im_start|>{name}\n"
                    if role == side:
                        masks.append((len(whole), len(whole) + len(text) + 10))
                    whole += f"{text}<|im_end|>\n"
                out.append((conv, n // size, side, len(own), whole, tuple(masks)))
    return sorted(map(str, out))


def test_every_segment_for_every_speaker(spark):
    # One speaks in the first turns only, a segment has no named speaker, one only system's turns.
    rows = [(1, 0, "system", "rules"), (1, 1, "system", "more")] + [(1, i, "cy", f"c{i}") for i in range(2, 11)]
    rows += [(1, i, "ann" if i % 2 else "bob", f"t{i}") for i in range(11, 128)]
    rows += [(1, i, None if i < 192 else "system", f"u{i}") for i in range(128, 256)]
    rows = rows_of_long_dialogues(rows)
    assert result(table(spark, rows)) == whole_brute(rows)
    assert result(table(spark, rows), segment_turns=7) == whole_brute(rows, 7)


def rows_of_long_dialogues(rows):
    # System turns open over more than a segment; no number, no dialogue; nobody named.
    rows += [(2, i, "system", f"s{i}") for i in range(150)] + [(2, 150, "ann", "hi"), (2, None, "bob", "end")]
    rows += [(None, i, "system" if i < 3 else "dan" if i < 9 else None, f"n{i}") for i in range(140)]
    rows += [(3, i, None, "x") for i in range(70)] + [(4, 0, "ann", "short")]
    return rows


def test_sql_takes_long_dialogues_alike(spark):
    import duckdb
    from carelayers.llm import queries

    rows = [(1, i, "ann" if i % 3 else "bob", f"t{i}") for i in range(2, 210)] + [(1, i, "system", "rule") for i in range(2)]
    rows = rows_of_long_dialogues([(c + 9, *r) for c, *r in rows])
    connection = duckdb.connect()
    connection.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    connection.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    cursor = connection.execute(queries.OP9_SQL)
    names = [c[0] for c in cursor.description]
    assert names == ["conv_id", "segment", "perspective", "n_turns", "text", "masks"]
    spans = lambda m: tuple(tuple(map(int, x.split(":"))) for x in m.split(",")) if m else ()
    assert sorted(str((*r[:5], spans(r[5]))) for r in cursor.fetchall()) == whole_brute(rows)


def test_only_built_in_functions(spark, plan):
    text = plan(chat.perspectives(table(spark, [(1, 0, "a", "x")])))
    assert not any(x in text for x in ("EvalPython", "InPandas", "InArrow", "Cartesian"))
