"""The rule table and the rules on rows with planted violations."""

from clutchforge.operators.dq import Model, model_rules
from clutchforge.plans import rules


def test_planted_violations_are_counted_and_named(spark):
    rows = [("a", 1, "x", 5), ("b", None, "y", -1), ("c", None, None, 0), (None, None, "z", -3), ("d", 2, "x", None), ("e", 3, "Q", -2)]
    df = spark.createDataFrame(rows, "id string, n int, label string, amount int")
    model = Model("t", "id", ("id", "n", "label"), {"label": ("x", "y"), "n": (1, 2)}, ("amount", "n"))
    got = {(r.rule, r.column): (r.failures, r.sample_key) for r in model_rules(model, df).collect()}
    assert got == {("not_null", "id"): (1, None), ("not_null", "n"): (3, "b"), ("not_null", "label"): (1, "c"),
                   ("accepted_values", "label"): (2, "e"), ("accepted_values", "n"): (1, "e"),
                   ("expression_is_true", "amount >= 0"): (3, "b"), ("expression_is_true", "n >= 0"): (0, None)}
    assert {r.failures for r in model_rules(model, df.limit(0)).collect()} == {0}
    assert [r.rule for r in model_rules(model, df, ("accepted_values",)).collect()] == ["accepted_values"] * 2


def test_one_pass_per_table(spark):
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    model = Model("t", "id", ("id", "n"), {"n": (1,)}, ("n",))
    plan = model_rules(model, df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_the_rule_table_is_whole(spark):  # conditions are columns
    kinds = [k for m in rules.RULES for k, _, _ in m.rules(("not_null", "accepted_values", "expression_is_true"))]
    assert (kinds.count("not_null"), kinds.count("accepted_values"), kinds.count("expression_is_true")) == (89, 14, 7)
    assert len({m.name for m in rules.RULES}) == len(rules.RULES) == 24
    for m in rules.RULES:
        assert m.name in rules.READERS or m.name in rules.core.CORE_TABLES or m.name in rules.marts.MART_TABLES
