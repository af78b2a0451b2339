"""Each rule just above and just below its threshold."""

import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import cast, decide, history, profile
from cellweave.plans import rules as R
from cellweave.plans.ingest import decide_table, type_table


def mix(share, yes, no, n=200):
    """A column of n values, the given share of which is ``yes`` (cycled through when a list)."""
    k = round(share * n)
    yes = yes if isinstance(yes, list) else [yes]
    no = no if isinstance(no, list) else [no]
    return [yes[i % len(yes)] for i in range(k)] + [no[i % len(no)] for i in range(n - k)]


WORD = "texte"
CASES = [
    # rules, column name, values, tag, method
    ("fqt", "x", mix(0.50, "2025-01-02", WORD), "DATE", "iso"),
    ("fqt", "x", mix(0.495, "2025-01-02", WORD), "STRING", "text"),
    ("fqt", "x", mix(0.90, "45000", WORD), "DATE", "serial"),
    ("fqt", "x", mix(0.895, "45000", WORD), "INT", "int"),
    ("fqt", "x", mix(0.70, "45000", "12"), "DATE", "serial"),
    ("fqt", "x", mix(0.695, "45000", "12"), "INT", "int"),
    ("fqt", "x", mix(0.70, "13/02/2025", WORD), "DATE", "day_first"),
    ("fqt", "x", mix(0.695, "13/02/2025", WORD), "STRING", "text"),
    ("fqt", "date", mix(0.50, "13/02/2025", WORD), "DATE", "day_first"),
    ("fqt", "date", mix(0.495, "13/02/2025", WORD), "STRING", "text"),
    ("fqt", "date", mix(0.60, "02/13/2025", WORD), "DATE", "month_first"),
    ("fqt", "date_de_retrait", mix(0.01, "13/02/2025", WORD), "DATE", "day_first"),
    ("fqt", "x", mix(0.98, "oui", WORD), "BOOL", "boolean"),
    ("fqt", "x", mix(0.975, "oui", WORD), "STRING", "text"),
    ("fqt", "x", mix(0.85, "1 234,5", WORD), "FLOAT", "float"),
    ("fqt", "x", mix(0.845, "1 234,5", WORD), "STRING", "text"),
    ("fqt", "x", ["60000,4", "70000,2"], "INT", "int"),
    ("fnp", "x", ["160000,4", "170000,2"], "FLOAT", "float"),
    ("fqt", "x", mix(0.2, "0", "5"), "STRING", "text"),
    ("rpa", "x", mix(0.2, "0", "5"), "INT", "int"),
    # time of day: nulls count as timed except in fqt
    ("fqt", "x", mix(0.20, "2025-01-02 10:30:00", "2025-01-02"), "DATE", "iso"),
    ("fqt", "x", mix(0.205, "2025-01-02 10:30:00", "2025-01-02"), "DATETIME", "iso"),
    ("fqt", "x", mix(0.25, None, "2025-01-02"), "DATE", "iso"),
    ("fnp", "x", mix(0.25, None, "2025-01-02"), "DATETIME", "iso"),
    ("rpa", "x", mix(0.20, None, "2025-01-02"), "DATE", "iso"),
    # serial bounds per rules
    ("fnp", "x", ["106750"], "DATE", "serial"),
    ("fnp", "x", ["106751"], "INT", "int"),
    ("rpa", "x", ["60000"], "DATE", "serial"),
    ("rpa", "x", ["60001"], "INT", "int"),
    ("fqt", "x", ["132320"], "DATE", "serial"),
    ("fqt", "x", ["132321"], "INT", "int"),
    ("spa", "x", ["45000"], "INT", "int"),
    ("spa", "Échéance", ["45000"], "DATE", "serial"),
    ("paae", "annee", ["2025"], "DATE", "day_first"),
    ("paae", "x", mix(0.50, "13/02/2025", WORD), "DATETIME", "day_first"),  # what does not parse counts as timed
    ("paae", "x", mix(0.495, "13/02/2025", WORD), "STRING", "text"),
    # names
    ("rpa", "Montant", mix(0.01, "1,5", WORD), "FLOAT", "float"),
    ("rpa", "Montant", mix(0.01, "1", WORD), "INT", "int"),
    ("rpa", "Code", ["12"], "STRING", "text"),
    ("rpa", "Code", mix(0.99, "oui", WORD), "BOOL", "boolean"),
    ("spa", "Intitulé", mix(0.01, "1", WORD), "FLOAT", "float"),
    ("spa", "Taux", mix(0.01, "1,5", WORD), "FLOAT", "float"),
    ("spa", "Code", ["12"], "INT", "int"),
    ("paae", "Section Analytique", ["12"], "STRING", "text"),
    ("paae", "h", mix(0.01, "12 €", WORD), "FLOAT", "float"),
    ("paae", "x", mix(0.85, "12 €", WORD), "INT", "int"),
    ("fqt", "vide", [None, None], "STRING", "text"),
]


@pytest.fixture(scope="module")
def decided(spark):
    """All cases of a rule set profiled together: (rules, case) -> (tag, method)."""
    out = {}
    for name, r in R.INFERRED.items():
        rows = [(str(i), v) for i, case in enumerate(CASES) if case[0] == name for v in case[2]]
        cells = spark.createDataFrame(rows, "name string, value string").repartition(3)
        hints = {str(i): case[1] for i, case in enumerate(CASES) if case[0] == name}
        names = spark.createDataFrame(list(hints.items()), "name string, header string")
        from cellweave.functions import text

        hint = {"column": F.col("header"), "header": text.fold(F.col("header")), "snake": text.snake(F.col("header"))}
        stats = profile.profile_cells(cells, r, ["name"]).join(names, "name").withColumn("hint", hint[r.hint_name])
        for row in decide.decide(stats, r).collect():
            out[int(row.name)] = (row.tag, row.method)
    return out


@pytest.mark.parametrize("i", range(len(CASES)), ids=lambda i: f"{CASES[i][0]}-{CASES[i][1]}-{i}")
def test_rule(decided, i):
    assert decided[i] == CASES[i][3:]


def test_profile_is_independent_of_partitions(spark):
    values = mix(0.6, ["1 234,5", "2025-01-02", "oui"], [None, " ", "0"])
    cells = spark.createDataFrame([("a", v) for v in values], "name string, value string")
    one, many = (profile.profile_cells(d, R.FQT, ["name"]).first().asDict() for d in (cells.coalesce(1), cells.repartition(7)))
    assert one == many
    assert one["n"] == 200 and one["n_value"] == one["n_nonnull"] + 26


def test_lost_values_and_types(spark):
    df = spark.createDataFrame([("1,5",), ("x",), ("2,5",)] + [("3",)] * 20, "montant string")
    row = decide_table(df, R.RPA).first()
    assert (row.tag, row.lost_values) == ("FLOAT", 1)
    assert type_table(df, R.RPA).dtypes == [("montant", "double")]


def test_cast_step_and_single_expression_agree(spark):
    values = ["13/02/2025", "x", None, " 1 234,5 ", "45000", "oui", "2025-01-02 10:30:00", "0"]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    for tag, method in [("DATE", "day_first"), ("FLOAT", "float"), ("INT", "int"), ("DATETIME", "serial"), ("BOOL", "boolean"), ("DATETIME", "iso"), ("STRING", "text")]:
        by_steps = cast.cast_table(df, [cast.TypedColumn("a", "a", tag, method)], R.FQT).collect()
        at_once = df.select(cast.cast_value(F.col("a"), tag, method, R.FQT).alias("a")).collect()
        assert by_steps == at_once


def profiles_of(spark, monkeypatch, shrinks, cells):
    monkeypatch.setattr(profile, "SHRINKS", shrinks)
    return {r.name: r.asDict() for r in profile.profile_cells(cells, R.FQT, ["name"]).collect()}


def test_counting_by_text_changes_no_statistic(spark, monkeypatch):
    values = mix(0.6, ["1 234,5", "2025-01-02", "oui", "45000", "13/02/2025 10:30", "inf"], [None, " ", "0", "nan", "x"])
    rows = [("many", v) for v in values * 3] + [("each", f"{i} 000,5") for i in range(300)] + [("none", None)] * 5
    cells = spark.createDataFrame(rows, "name string, value string").repartition(3)
    # All columns by text, none of them, and as they come.
    by_text, by_cell, chosen = (profiles_of(spark, monkeypatch, s, cells) for s in (0, 10**6, 2))
    assert by_text == by_cell == chosen
    monkeypatch.setattr(profile, "SHRINKS", 2)
    left = {(r.name, r.n): r.weight for r in profile.weighted(cells, ["name"]).groupBy("name").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    assert left[("each", 300)] == 300 and sum(left.values()) == len(rows)
    assert next(n for name, n in left if name == "many") <= 12


def test_profiles_of_parts_add_up_to_that_of_the_whole(spark, tmp_path):
    rows = [("a", "1"), ("a", "2,5"), ("b", None), ("b", "oui"), ("c", "2025-01-02"), ("a", "x"), ("c", "2025-01-02 10:00:00"), ("d", "7")]
    whole = spark.createDataFrame(rows * 4, "name string, value string")
    store = history.ProfileStore(str(tmp_path / "profiles"))
    for load_id, part in (("one", rows * 3), ("two", rows), ("two", rows)):
        store.add(profile.profile_cells(spark.createDataFrame(part, whole.schema), R.FQT, ["name"]), load_id)
    found = {r.name: r.asDict() for r in store.profile(spark, ["name"]).collect()}
    assert found == {r.name: r.asDict() for r in profile.profile_cells(whole, R.FQT, ["name"]).collect()}
    assert store.loads(spark) == ["one", "two"]


def test_whole_numbers_in_one_part_only(spark):
    parts = [[("a", "1"), ("b", "1"), ("c", "x")], [("a", "x"), ("b", "1,5"), ("c", "y")]]
    frames = [profile.profile_cells(spark.createDataFrame(p, "name string, value string"), R.FQT, ["name"]) for p in parts]
    found = {r.name: r.all_integral for r in history.add_profiles(frames[0].unionByName(frames[1]), ["name"]).collect()}
    assert found == {"a": True, "b": False, "c": False}


def test_columns_widen_to_a_type_that_holds_both(spark):
    stored = [("a", "INT"), ("b", "DATETIME"), ("c", "BOOL"), ("d", "DATE"), ("e", "STRING"), ("f", "FLOAT"), ("gone", "INT")]
    decided = [("a", "FLOAT"), ("b", "DATE"), ("c", "INT"), ("d", "DATE"), ("e", "INT"), ("f", "INT"), ("new", "BOOL")]
    frames = [spark.createDataFrame(x, "name string, tag string") for x in (stored, decided)]
    found = {r.name: (r.tag, r.must_widen) for r in history.widening(*frames).collect()}
    assert found == {
        "a": ("FLOAT", True), "b": ("DATETIME", False), "c": ("STRING", True), "d": ("DATE", False), "e": ("STRING", False),
        "f": ("FLOAT", False), "gone": ("INT", False), "new": ("BOOL", False),
    }


def test_a_date_is_rewritten_once(spark):
    df = spark.createDataFrame([("13/02/2025",), ("1.2.25",), ("31/02/2024",), (" 05-06-2025 10:30 ",)], "d string")
    typed = cast.cast_table(df, [cast.TypedColumn("d", "d", "DATETIME", "day_first")], R.FNP)
    assert [r.d and r.d.isoformat() for r in typed.collect()] == ["2025-02-13T00:00:00", "2025-02-01T00:00:00", None, "2025-06-05T10:30:00"]
    assert typed._jdf.queryExecution().optimizedPlan().toString().count(" 20$3-$1-$2") == 1


def odd_texts(n):
    """Amounts, dates with times, whole numbers and words near the bounds of what ``alike`` makes equal."""
    pick = random.Random(7)
    digits = lambda k: "".join(pick.choice("0123456789") for _ in range(k))
    gap = lambda: pick.choice(["", " ", "\xa0", " ", "."])
    makers = [
        lambda: pick.choice(["", "-", "+"]) + digits(pick.randint(0, 3)) + gap() + pick.choice([digits(3), "999", "000"]) + "," + pick.choice([digits(2), "00", "50", "1"]),
        lambda: pick.choice(["", "-"]) + str(pick.randint(1, 999)) + gap() + digits(3) + gap() + digits(3) + "," + pick.choice([digits(2), "00"]),
        lambda: pick.choice(["2024-02-30", "1677-09-21", "2262-04-12", "13/02/2025", "1.2.24"]) + pick.choice(" T") + pick.choice(["10:30:00", "00:00:00", "24:00:00", "09:05"]) + pick.choice(["", ".000", ".25"]),
        lambda: pick.choice(["", "-", "0"]) + digits(pick.choice([5, 7, 8, 9, 18])),
        lambda: f"{pick.randint(1600, 2300)}{pick.randint(0, 13):02d}{pick.randint(0, 32):02d}",
        lambda: " ".join(pick.choice(["janvier", "May", "12", "2024", "infinity", "oui", "Customer#1", "13/02/2024", "12,50", "10:30:00"]) for _ in range(3)),
    ]
    return sorted({pick.choice(["", "", " ", "\n"]) + pick.choice(makers)() + pick.choice(["", "", "\xa0", "\x85"]) for _ in range(n)})


@pytest.mark.parametrize("rules", R.INFERRED.values(), ids=lambda r: r.name)
def test_texts_made_alike_have_the_same_statistics(spark, rules):
    texts = spark.createDataFrame(list(enumerate(odd_texts(4000))), "name int, text string")
    changed = texts.withColumn("value", profile.alike(F.col("text"))).filter("value <> text").localCheckpoint()
    assert changed.count() > 800 > 2 * changed.select("value").distinct().count()

    def statistics(value):
        cells = changed.select("name", F.col(value).alias("value"), F.lit(1).cast("long").alias("weight"))
        facts = profile.cell_facts(cells, rules, ["name", "weight"])
        return facts.groupBy("name").agg(*profile._statistics(rules))

    assert statistics("value").exceptAll(statistics("text")).collect() == []


def test_cells_are_looked_at_once_and_leave_few_texts(spark):
    amounts = spark.range(5000).selectExpr("'a' AS name", "concat(id % 30, ' ', lpad(id % 900, 3, '0'), ',', lpad(id % 7, 2, '0')) AS value")
    times = spark.range(5000).selectExpr("'b' AS name", "concat('2025-01-02 ', lpad(id % 24, 2, '0'), ':', lpad(id % 60, 2, '0'), ':07') AS value")
    names = spark.range(5000).selectExpr("'c' AS name", "concat('Customer#', lpad(id, 9, '0')) AS value")
    cells = amounts.unionByName(times).unionByName(names)
    left = profile.weighted(cells.select("name", profile.alike(F.col("value")).alias("value")), ["name"])
    assert {r["name"]: r["count"] for r in left.groupBy("name").count().collect()} == {"a": 210, "b": 1, "c": 1}
    plan = profile.profile_cells(cells, R.FQT, ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 3


def test_cents_are_rounded_once_for_a_row(spark, tmp_path):
    from workloads import base

    spark.sql("SELECT -1234.565d AS x UNION ALL SELECT null").write.parquet(str(tmp_path / "part.parquet"))
    df = base.derive(spark, str(tmp_path), f"SELECT {base.french('x', '.')} AS v FROM {{part}}")
    assert sorted((r.v for r in df.collect()), key=str) == ["-1.234,57", None]
    assert df.columns == ["v"] and df._jdf.queryExecution().optimizedPlan().toString().count("round(") == 1
