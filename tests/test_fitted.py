"""What the feature pipeline learns, and that it learns from the training part alone."""

import pytest
from pyspark.sql import functions as F

from ordermart.operators import fitted, ml
from ordermart.plans import pipeline
from ordermart.plans.session import cut_lineage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return cut_lineage(ml.add_folds(pipeline.orders_master(spark, SF)))


@pytest.fixture(scope="module")
def model(mart):
    return fitted.RiskFeatures().fit(mart.where("fold <> 0").drop("fold"))


def _rows(df):
    return {r.order_id: {k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.collect()}


def test_on_its_own_rows_it_is_the_plain_pipeline(mart, model):
    train = mart.where("fold <> 0").drop("fold")
    assert _rows(model.transform(train)) == _rows(pipeline.preprocess(train))


def test_held_out_rows_change_nothing_learned(mart, model):
    changed = mart.withColumns({c: F.when(F.col("fold") == 0, F.lit(v)).otherwise(F.col(c)) for c, v in (
        ("price", 1e6), ("review_score", 5.0), ("payment_type", "new"), ("customer_city", "nowhere"), ("seller_id", "none"), ("total_payment", 1.0))})
    again = fitted.RiskFeatures().fit(changed.where("fold <> 0").drop("fold"))
    assert again.state == model.state and set(again.tables) == set(model.tables)
    for name, table in model.tables.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, again.tables[name].collect()))
    new = {r.order_id: r for r in model.transform(changed.where("fold = 0").drop("fold")).collect()}
    assert new and all(r.payment_type_credit_card == r.payment_type_voucher == 0 for r in new.values())
    mean, std = model.state["moments"]["customer_city_freq"]
    assert all(abs(r.customer_city_freq - (0 - mean) / (std + 1e-10)) < 1e-9 for r in new.values())


def test_saved_and_loaded(mart, model, tmp_path):
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    loaded = fitted.RiskFeaturesModel.load(path)
    held = mart.where("fold = 0").drop("fold")
    assert loaded.uid == model.uid and _rows(loaded.transform(held)) == _rows(model.transform(held))
    fitted.RiskFeatures(maskedReview=True).write().overwrite().save(path + "e")
    assert fitted.RiskFeatures.load(path + "e").getOrDefault("maskedReview")


def test_held_out_orders_are_imputed_with_the_training_part(mart, model):
    base = cut_lineage(fitted.base_rows(mart))
    again, ol = fitted.RiskFeatures().learn(base.where("fold <> 0").drop("fold"), base.drop("fold"), ml.hash_fold("order_id", 5) == 0)
    assert again.state == model.state
    assert _rows(again.coded_and_scaled(ol)) == _rows(model.transform(mart.drop("fold")))
