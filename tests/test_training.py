"""Training as registered: it ends by its stop rule, and is stored, read back and shared."""
import math

from pyspark.sql import functions as F

from pricewise.operators import modeling as md
from pricewise.plans import q_model
from pricewise.session import path_exists

SF = "/root/testdata/sf0.001"


def test_boosting_ends_by_the_held_out_loss(spark):
    x = [f"x{k}" for k in range(6)]
    rows = spark.range(4000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100)) / 100.0).alias(c) for k, c in enumerate(["noise", *x])])
    rows = rows.withColumn("label", sum((F.when(F.col(c) > 0.4, 1.0).otherwise(0.0) for c in x), F.col("noise")))
    model, loss = md.fit_trees(rows, x, [], ["id"], max_depth=2, tolerance=0.01)
    rounds = model.stages[-1].getNumTrees
    assert rounds in (25, 50, 100, 200) and len(loss) == 2 * rounds
    assert loss[rounds - 1] < 0.13 < 0.5 < loss[0]  # the noise alone has 1 / 12
    assert loss[-1] > loss[rounds - 1] * 0.99 and (rounds == 25 or loss[rounds - 1] <= loss[rounds // 2 - 1] * 0.99)
    shorter, curve = md.fit_trees(rows, x, [], ["id"], max_depth=2, max_iter=25)
    assert all(math.isclose(a, b) for a, b in zip(curve, loss[:25], strict=True)) and shorter.stages[-1].getNumTrees == 25


def test_registered_training(spark):
    found = q_model.train_boosted_trees(spark, SF)
    path = q_model.trained(spark, SF)
    assert path_exists(spark, f"{path}/model") and q_model.trained(spark, SF) == path
    rows = found.collect()
    assert rows and all(r.predict >= 0 and math.isclose(r.predict, max(math.expm1(r.prediction), 0)) for r in rows)
    assert all(r.predict_sales_qty == round(r.past_3_median_aps * r.predict) for r in rows)
    loss = [r.held_out_loss for r in q_model.training_loss(spark, SF).where("kept").orderBy("round").collect()]
    model = md.load_model(f"{path}/model")
    assert 1 < model.stages[-1].getNumTrees == len(loss) <= 900
    # M7: what is read back scores as what was stored
    num, cat = md.model_features(model)
    assert "past_3_median_aps" in num and "gender_group" in cat and not {"sales_qty", "sales_amt", "inv_qty"} & {*num, *cat}
    train, test = md.split_by_key(md.boost_label(q_model.training_rows(spark, SF), "sales_qty", "past_3_median_aps"),
                                  ["style_cd", "sales_date"], q_model.RATIO, q_model.SEED)
    again = md.score_forecast(model, md.encode_missing(test, num), "past_3_median_aps")
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in rows)
    assert q_model.boost_confusion_matrix(spark, SF).count() > 0
