import pytest
from conftest import values

from sluice import Condition, Recipe
from sluice.operators import sql
from sluice.operators.aggregate import Aggregation

ROWS = [(1, "a-x", 10.0), (2, "b-y", 20.0), (3, "a-z", None)]
SCHEMA = "id int, code string, n double"


@pytest.fixture
def df(table):
    return table(ROWS, SCHEMA)


def recipe():
    return (
        Recipe()
        .add("split_column", column="code", delimiter="-", new_columns=["head", "tail"])
        .add("math", expression="n * 2", new_column="twice")
        .add("math", expression="twice + 1", new_column="more")
        .add("filter_rows", condition=Condition("more", "GT", 20))
        .add("text_transform", columns=["tail"], case="UPPER")
    )


def test_steps_and_sequence(df):
    made = recipe()
    assert values(made.apply(df), "id", "tail", "more") == [(1, "X", 21.0), (2, "Y", 41.0)]
    assert made.at(0).apply(df).columns == df.columns
    assert made.at(2).apply(df).columns == [*df.columns, "head", "tail", "twice"]
    with pytest.raises(ValueError):
        made.at(9)


def test_fused_and_separate_steps_agree(df):
    made = recipe()
    assert values(made.apply(df)) == values(made.apply(df, fuse=False))


def test_neighbouring_column_steps_become_one_projection(df, monkeypatch):
    calls = []
    original = type(df).withColumns
    monkeypatch.setattr(
        type(df), "withColumns", lambda self, cols: calls.append(list(cols)) or original(self, cols)
    )
    made = Recipe()
    for i in range(10):
        made = made.add("math", expression=f"n + {i}", new_column=f"m{i}")
    assert len(made.apply(df).columns) == 13
    assert calls == [[f"m{i}" for i in range(10)]]


def test_edits_are_new_recipes(df):
    made = recipe()
    shorter = made.delete(4)
    assert (len(made.steps), len(shorter.steps)) == (5, 4)
    assert shorter.apply(df).count() == 3
    assert made.insert(1, "limit_rows", n=1, order_by=["id"]).apply(df).count() == 1
    swapped = made.replace_step(4, "filter_rows", condition=Condition("id", "EQ", 1))
    assert swapped.apply(df).count() == 1
    with pytest.raises(ValueError):
        made.delete(6)
    with pytest.raises(ValueError, match="unknown step"):
        made.add("explode_everything")


def test_json_round_trip(df, table):
    other = table([(1, "one")], "key int, word string")
    made = (
        recipe()
        .add("lookup", source="id", other={"view": "words"}, key="key", value="word", new_column="w")
        .add("pivot", group_by=["w"], aggregations=[Aggregation("n", "SUM", "total")])
    )
    again = Recipe.from_json(made.to_json())
    assert again.to_json() == made.to_json()
    tables = {"words": other}
    assert values(again.apply(df, tables)) == [("one", 10.0), (None, 20.0)]
    with pytest.raises(ValueError, match="no table"):
        again.apply(df)


def test_parameters(df):
    made = Recipe(parameters={"low": "NUMERIC"}).add(
        "filter_rows", condition={"column": "n", "operator": "GTE", "value": "$low"}
    )
    assert made.apply(df, params={"low": 15}).count() == 1
    with pytest.raises(ValueError, match="no value"):
        made.apply(df)
    with pytest.raises(ValueError, match="NUMERIC"):
        made.apply(df, params={"low": "15"})
    assert made.fingerprint({"low": 1}) != made.fingerprint({"low": 2})


def test_checkpoints_rerun_only_what_follows(df, tmp_path, spark):
    folder = str(tmp_path / "points")
    made = recipe()
    first = values(made.checkpointed(df, folder, "v1", every=[2, 4]))
    # with other data under the same label the checkpoint still answers
    empty = df.limit(0)
    assert values(made.checkpointed(empty, folder, "v1", every=[2, 4])) == first
    assert values(made.checkpointed(empty, folder, "v2", every=[2, 4])) == []
    edited = made.replace_step(5, "text_transform", columns=["head"], case="UPPER")
    assert values(edited.checkpointed(empty, folder, "v1", every=[2, 4]), "head") == [("A",), ("B",)]


def test_lint(df):
    made = Recipe().add("math", expression="code + 1", new_column="x").add("sort", order_by=["nope"])
    notes = made.lint(df)
    assert "TEXT" in notes[0]
    assert "nope" in notes[1]
    assert recipe().lint(df) == []


def test_sql(df):
    assert values(sql.sql_query(df, 'SELECT "id" FROM dataview WHERE n > :low', {"low": 15})) == [(2,)]
    assert values(sql.sql_query(df, "SELECT count(*) c FROM __TABLE__")) == [(3,)]
    assert values(sql.sql_query(df, "SELECT {x} AS v FROM this", snippets={"x": "n * {y}", "y": "2"})) == [
        (20.0,),
        (40.0,),
        (None,),
    ]
    assert values(sql.sql_query(df, "SELECT 'a;b' AS v FROM this LIMIT 1")) == [("a;b",)]


@pytest.mark.parametrize(
    "text",
    ["DROP TABLE dataview", "SELECT 1; SELECT 2", "INSERT INTO x SELECT 1", "SELECT {x} FROM this"],
)
def test_only_single_queries(df, text):
    with pytest.raises(ValueError):
        sql.sql_query(df, text)


def test_sql_leaves_the_session_as_it_was(df, spark):
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    sql.sql_query(df, "SELECT 1")
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == before
    assert not spark.catalog.tableExists("dataview")


def test_export_as_of_a_step(df, spark, tmp_path):
    made = recipe()
    low, high = Condition("id", "EQ", 3), Condition("id", "LT", 3)
    assert "head" in made.export(df, str(tmp_path / "a"), low, after=2)
    made.export(df, str(tmp_path / "b"), high)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2
    with pytest.raises(ValueError, match="does not fit|unknown"):
        made.export(df, str(tmp_path / "c"), Condition("more", "GT", 1), after=1, validate_only=True)


def test_steps_as_methods(df):
    made = (
        Recipe()
        .filter_rows(Condition("n", "IS_NOT_EMPTY"))
        .math("n * 2", "twice")
        .window("ROW_NUMBER", new_column="place", order_by=[["n", "DESC"]])
    )
    assert values(made.apply(df), "id", "twice", "place") == [(1, 20.0, 2), (2, 40.0, 1)]
    assert made.steps[1].params == {"expression": "n * 2", "new_column": "twice"}
    with pytest.raises(AttributeError):
        Recipe().explode_everything


def test_sql_cannot_write(df, tmp_path):
    for text in (
        f"FROM this INSERT OVERWRITE DIRECTORY '{tmp_path}/x' USING parquet SELECT *",
        "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
        "INSERT INTO t VALUES (1)",
    ):
        with pytest.raises(ValueError, match="quer"):
            sql.sql_query(df, text)
    assert not (tmp_path / "x").exists()
    assert sql.sql_query(df, "SELECT 'insert into x; y' AS s FROM this -- ; no").first()["s"] == "insert into x; y"


def test_sql_leaves_the_callers_views(df, spark, table):
    table([(7,)], "v int").createOrReplaceTempView("this")
    assert sql.sql_query(df, "SELECT count(*) AS n FROM this").first()["n"] == 3
    assert values(spark.table("this")) == [(7,)]
    spark.catalog.dropTempView("this")
    sql.sql_query(df, "SELECT 1 FROM this")
    assert "this" not in {t.name for t in spark.catalog.listTables()}


def test_fused_steps_see_parameters_bound(table):
    df = table([("ann", "x")], "name string, other string")
    made = Recipe(parameters={"c": "TEXT"}).add("text_transform", columns=["name"], case="UPPER")
    made = made.add("combine_columns", sources=["$c"], new_column="both")
    for fuse in (True, False):
        assert made.apply(df, params={"c": "name"}, fuse=fuse).first()["both"] == "ANN"


def test_checkpoints_depend_on_the_joined_tables(df, table, tmp_path):
    made = Recipe().add("join", other={"view": "o"}, on=[["id", "k"]], select=["w"])
    got = []
    for word in ("one", "two"):
        other = table([(1, word)], "k int, w string")
        out = made.checkpointed(df, str(tmp_path), "v1", every=[1], tables={"o": other}, table_sources={"o": word})
        got.append(sorted(r["w"] for r in out.collect() if r["w"]))
    assert got == [["one"], ["two"]]


def test_recipes_with_tables_are_not_saved(df):
    with pytest.raises(TypeError, match="cannot be saved"):
        Recipe().add("join", other=df, on=["id"]).to_json()


def test_checks_tags_and_access_are_steps_that_can_be_saved(df, table):
    from sluice.operators.quality import Check

    made = Recipe().add("flag_rows", checks=[Check("has n", "not_null", "n"), Check("low", "condition", condition=Condition("id", "LT", 3))])
    again = Recipe.from_json(made.to_json())
    assert values(again.apply(df), "id", "failed_checks") == values(made.apply(df), "id", "failed_checks") == [(3, "has n, low")]
    tagged = Recipe().add("conditional_format", rules=[["red", "n", Condition("n", "GT", 15)]])
    assert values(Recipe.from_json(tagged.to_json()).apply(df), "id", "format_tags") == [(1, ""), (2, "n:red"), (3, "")]
    access = table([("ann", "a-x", False)], "viewer string, value string, all_access boolean")
    own = Recipe().add("row_level_security", column="code", viewer="ann", assignments={"view": "access"})
    assert values(Recipe.from_json(own.to_json()).apply(df, {"access": access}), "id") == [(1,)]
