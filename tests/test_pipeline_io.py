"""Files in, files out: the four steps on a small export, readers, sinks and the scoring stream."""

import pytest
from pyspark.sql import functions as F

from upkeep.models import classifiers as cl
from upkeep.models.anomaly import AnomalyDetector, AnomalyModel
from upkeep.models.run import run_models
from upkeep.models.scoring import ScoringProfile, score_orders
from upkeep.plans.effectiveness import run_effectiveness
from upkeep.plans.features import feature_table, run_features
from upkeep.plans.integration import run_preprocessing
from upkeep.plans.spare_parts import run_spare_parts
from upkeep.sources.readers import read_raw_tables, read_summary, read_table
from upkeep.sources.schemas import RAW_TABLES
from upkeep.sources.writers import write_table
from upkeep.streaming.scoring import arriving_orders, score_stream


def exports(spark):
    """Raw tables with every declared column, as the exports deliver them."""
    n = F.col("id")
    day = F.expr("timestamp'2025-01-01 08:00:00' + make_dt_interval(cast(id % 89 as int), cast(id % 11 as int))")
    later = day + F.expr("make_dt_interval(cast(id % 3 as int), 5)")
    text = lambda t, f: F.date_format(t, f)
    place = {
        "portfolio": F.lit("batiment"),
        "site": F.concat(F.lit("S"), n % 3),
        "zone": F.concat(F.lit("Z"), n % 4),
        "famille": F.concat(F.lit("F"), n % 5),
        "groupe": F.lit("G"),
        "localisation": F.concat(F.lit("L"), n % 6),
        "actif": F.concat(F.lit("A"), n % 40),
        "id_actif": n % 40,
        "prestataire": F.concat(F.lit("P"), n % 4),
    }
    values = {
        "corrective": {
            **place,
            "id_ordre_travail": n,
            "etat": F.lit("Clotur�"),
            "anomalie": F.concat(F.lit("type "), n % 7),
            "urgence": F.element_at(F.array(F.lit("Fort"), F.lit("Moyen"), F.lit("Faible")), (n % 3 + 1).cast("int")),
            "est_reouvert": F.when(n % 10 == 0, "Oui").otherwise("Non"),
            "cout_total": F.when(n % 8 != 0, (n * 37 % 101).cast("double")),
            "duree_intervention_par_heure": (n % 9).cast("double"),
            "nombre_main_doeuvre": n % 3,
            "date_declaration": text(day, "dd/MM/yyyy HH:mm"),
            "date_creation_ot": text(day, "dd/MM/yyyy HH:mm"),
            "date_cloture": text(later, "dd/MM/yyyy HH:mm"),
            "commentaire_cloture": F.lit('two\nlines, "quoted"'),
        },
        "preventive": {
            **place,
            "numero_ot": n,
            "etat": F.lit("Realise"),
            "nom_intervention": F.lit("visite"),
            "frequence": F.lit("M"),
            "cout": (n % 50).cast("double"),
            "date_debut_planifiee": day,
            "date_debut": later,
            "date_fin": later,
            "date_cloture": later,
        },
        "spare_parts": {
            "id_demande": n,
            "id_ot": n * 2 % 160,
            "article": F.concat(F.lit("art "), n % 12),
            "famille": F.concat(F.lit("PF"), n % 3),
            "quantite_demande": (n % 5).cast("double"),
            "quantite_dispo": n % 7,
            "cout_total": (n % 90).cast("double"),
            "etat": F.when(n % 6 == 0, "rejet").otherwise("valide"),
            "date_demande": text(day, "dd/MM/yyyy, HH:mm:ss"),
        },
    }
    sizes = {"corrective": 160, "preventive": 120, "spare_parts": 60}
    for name, schema in RAW_TABLES.items():
        known = values[name]
        columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        yield name, spark.range(sizes[name]).select(*columns)


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipeline"))
    for name, df in exports(spark):
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{base}/raw/{name}.csv")
    run_preprocessing(spark, f"{base}/raw", f"{base}/processed", csv=True, multiline=True)
    return base


def test_preprocessing_writes_every_table(spark, work):
    table = lambda name: read_table(spark, f"{work}/processed", name)
    assert table("corrective_cleaned").count() == 160 and table("unified_timeline").count() == 280
    assert table("asset_master").count() == 40 and table("location_hierarchy").count() == 12
    orders = table("corrective_integrated")
    assert orders.where("etat = 'Cloture' and est_reouvert is not null and cout_total is not null").count() == 160
    assert orders.where("num_spare_parts_requests > 0").count() == 60
    assert orders.first()["commentaire_cloture"].startswith("two\nlines")
    january = table("unified_timeline").where("month = '2025-01'")
    assert 0 < january.count() < 280
    csv_twin = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{work}/processed/location_hierarchy.csv")
    assert csv_twin.count() == 12


def test_missing_table_names_what_is_there(spark, folder):
    spark.range(1).write.parquet(f"{folder}/corrective.parquet")
    with pytest.raises(FileNotFoundError, match="corrective.parquet"):
        read_raw_tables(spark, folder)


def test_csv_files_with_another_column_order_are_an_error(spark, folder):
    parts = dict(exports(spark))["spare_parts"]
    raw = f"{folder}/raw"
    for name, df in exports(spark):
        if name != "corrective":
            df.write.option("header", True).csv(f"{raw}/{name}.csv")
    orders = dict(exports(spark))["corrective"].drop("commentaire_cloture")
    orders.coalesce(1).write.option("header", True).csv(f"{raw}/corrective.csv")
    assert read_raw_tables(spark, raw)["corrective"].where("site like 'S%' and famille like 'F%'").count() == 160
    parts.select(*reversed(parts.columns)).coalesce(1).write.mode("append").option("header", True).csv(f"{raw}/spare_parts.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_tables(spark, raw)["spare_parts"].collect()


def test_scoring_uses_the_codes_of_training(spark, work):
    orders = read_table(spark, f"{work}/processed", "corrective_integrated")
    # families below all others, known from orders without a site only: every later code moves by one
    moved = orders.withColumns(
        {
            "site": F.when(F.col("id_ordre_travail") % 7 == 0, None).otherwise(F.col("site")),
            "famille": F.when(F.col("id_ordre_travail") % 7 == 0, "A0").otherwise(F.col("famille")),
        }
    )
    trained = feature_table(moved)
    new = moved.select(
        *"id_ordre_travail site famille portfolio urgence anomalie cout_total duree_intervention_par_heure nombre_main_doeuvre date_creation_ot".split(),
        F.lit(9).alias("creation_hour"),
        F.lit(2).alias("creation_day_of_week"),
        F.lit(2).alias("previous_failures"),
        F.lit(15.0).alias("days_since_last_maintenance"),
    )
    codes = ["id_ordre_travail", "site_encoded", "famille_encoded", "portfolio_encoded"]
    completed = ScoringProfile.fit(moved, trained).complete(new).select(codes)
    assert completed.count() == 160
    assert completed.select([F.col(c).cast("long") for c in codes]).exceptAll(trained.select([F.col(c).cast("long") for c in codes])).count() == 0


def test_processed_csv_times_are_parsed_again(spark, folder):
    rows = spark.createDataFrame([("2025-01-05",), ("2025-01-05 09:05:00",), ("1/5/2025 9:05",), ("?",)], "date_creation_ot string")
    rows.write.option("header", True).csv(f"{folder}/orders.csv")
    got = read_table(spark, folder, "orders", ["date_creation_ot"])
    assert got.schema["date_creation_ot"].dataType.typeName() == "timestamp"
    assert got.where("date_creation_ot is not null").count() == 3
    write_table(spark.range(3), folder, "orders")
    assert read_table(spark, folder, "orders").count() == 3  # the typed table wins


@pytest.fixture(scope="module")
def features(spark, work):
    return run_features(spark, f"{work}/processed", f"{work}/features")


def test_feature_step(spark, work, features):
    meta = read_summary(spark, f"{work}/features", "feature_metadata").first()
    assert meta["total_samples"] == 160 and meta["total_features"] == len(features.columns)
    assert "rolling_7d_failures" in meta["numerical_features"] and "site" in meta["categorical_features"]
    assert len(meta["target_variables"]) == 5
    codes = read_table(spark, f"{work}/features", "label_codes")
    assert codes.where("column = 'site'").count() == 3
    assert read_summary(spark, f"{work}/features", "nothing") is None


def test_report_steps(spark, work):
    paths = run_effectiveness(spark, f"{work}/processed", f"{work}/reports")
    assert spark.read.parquet(paths["maintenance_intervals"]).count() > 0
    summary = read_summary(spark, f"{work}/reports", "effectiveness_summary").first()
    assert summary["n_families_analyzed"] == 5 and summary["total_with_data"] == 120
    run_spare_parts(spark, f"{work}/processed", f"{work}/reports")
    stock = read_summary(spark, f"{work}/reports", "spare_parts_summary").first()
    assert stock["pareto_total_articles"] == 12 and stock["rejection_count"] == 10
    assert sum(v for v in stock["top_stockout_families"].asDict().values()) == stock["stock_out_count"]


def test_model_step_and_stream_scoring(spark, work, features):
    quick = cl.ModelSettings(trees=3, depth=3, balanced=True, folds=0)
    boost = cl.ModelSettings(trees=2, depth=2, learning_rate=0.1, folds=0)
    out = f"{work}/models"
    run_models(spark, f"{work}/features", out, quick, boost, AnomalyDetector(trees=10, sample_size=32, map_size=32, steps=2))
    metrics = read_summary(spark, out, "model_metrics").first()
    assert metrics["anomaly_detection"]["total_samples"] == 160
    assert len(metrics["failure_prediction"]["confusion_matrix"]["rows"] if "rows" in metrics["failure_prediction"]["confusion_matrix"] else metrics["failure_prediction"]["confusion_matrix"]) == 4
    orders = read_table(spark, f"{work}/processed", "corrective_integrated")
    profile = ScoringProfile.fit(orders, features)
    models = (cl.Classifier.load(f"{out}/failure_predictor"), cl.Classifier.load(f"{out}/spare_parts_predictor"), AnomalyModel.load(f"{out}/anomaly", spark))
    new = orders.select(
        *"id_ordre_travail site famille portfolio urgence anomalie cout_total duree_intervention_par_heure nombre_main_doeuvre date_creation_ot".split(),
        F.hour("date_creation_ot").alias("creation_hour"),
        F.weekday("date_creation_ot").alias("creation_day_of_week"),
        F.lit(2).alias("previous_failures"),
        F.lit(15.0).alias("days_since_last_maintenance"),
    )
    batch = score_orders(new, profile, *models)
    assert batch.count() == 160 and batch.where("failure_probability between 0 and 1 and failure_risk is not null").count() == 160
    unknown = new.limit(1).withColumns({"famille": F.lit("new family"), "site": F.lit("new site"), "anomalie": F.lit("new")})
    assert score_orders(unknown, profile, *models).first()["anomaly_verdict"] is not None
    new.write.parquet(f"{work}/arriving")
    stream = arriving_orders(spark, f"{work}/arriving", new.schema)
    query = score_stream(stream, profile, f"{work}/scored", f"{work}/scored_log", *models, available_now=True)
    query.awaitTermination()
    scored = spark.read.parquet(f"{work}/scored")
    same = ["id_ordre_travail", "failure_prediction", "spare_parts_prediction", "anomaly_confidence"]
    assert scored.select(same).exceptAll(batch.select(same)).count() == 0 and scored.count() == 160


def test_months_become_as_many_files_whatever_the_tasks(spark, folder):
    from pathlib import Path

    from upkeep.sources.writers import write_timeline

    days = spark.range(3000).select(F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(cast(id % 300 AS int))").alias("date_created"), "id")
    counts = []
    for tasks in (3, 40):
        path = write_timeline(days.repartition(tasks), f"{folder}/{tasks}")
        counts.append(len(list(Path(path).glob("month=*/*.parquet"))))
        assert spark.read.parquet(path).count() == 3000
    assert counts[0] == counts[1] == 10


def test_csv_twin_is_read_without_inference(spark, folder):
    import shutil

    from upkeep.sources.readers import read_table, written_schema
    from upkeep.sources.writers import write_table

    df = spark.createDataFrame([(1, "007", 1.5, None), (2, 'a "b", c', None, True)], "id long, code string, v double, f boolean")
    write_table(df, folder, "t", csv=True)
    shutil.rmtree(f"{folder}/t.parquet")
    back = read_table(spark, folder, "t")
    assert back.schema == df.schema == written_schema(spark, folder, "t") and sorted(back.collect()) == sorted(df.collect())


def test_queries_split_methods_that_the_jvm_would_interpret(spark):
    from upkeep import catalog

    catalog.query(lambda session, folder: session.range(1))(spark, "")
    del catalog.QUERIES["<lambda>"]
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
