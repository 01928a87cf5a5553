"""The filter language, and counts under it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.operators import counts, filters, records, shred
from semstore.operators.filters import new_filter
from semstore.plans import workspace
from semstore.plans.workload.registry import register, table


def _where(df: DataFrame, flt, *columns: str) -> DataFrame:
    return df.where(filters.predicate(df, flt)).select(*columns)


def _documents(spark, folder):
    return table(spark, folder, "documents")


def _events(spark, folder):
    return table(spark, folder, "events")


def _labelled(spark, folder):
    """Documents with the labels some of them have; the others lack those keys."""
    return _documents(spark, folder).join(table(spark, folder, "labels"), "doc_id", "left")


@register("SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def filter_eq(spark, folder):
    return _where(_documents(spark, folder), {"match": {"key": "lang", "value": "en"}}, "doc_id", "lang")


@register("SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'en'")
def filter_ne(spark, folder):
    return _where(_documents(spark, folder), new_filter().where("lang").not_equals("en").build(), "doc_id", "lang")


@register("SELECT vec_id, label FROM embeddings WHERE label = 2")
def filter_strict_type(spark, folder):
    """Text never equals a number, and a boolean never does: only label 2 is found."""
    flt = filters.any_of({"label": "1"}, {"label": True}, {"label": 2.0}, {"label": 2.5})
    return _where(table(spark, folder, "embeddings"), flt, "vec_id", "label")


@register("SELECT event_id, value FROM events WHERE value > 50")
def filter_gt(spark, folder):
    return _where(_events(spark, folder), new_filter().where("value").greater_than(50).build(), "event_id", "value")


@register("SELECT event_id, user_id FROM events WHERE user_id >= 100")
def filter_ge(spark, folder):
    flt = new_filter().where("user_id").greater_than_or_equal(99.5).build()
    return _where(_events(spark, folder), flt, "event_id", "user_id")


@register("SELECT event_id, value FROM events WHERE value < 1.5")
def filter_lt(spark, folder):
    return _where(_events(spark, folder), new_filter().where("value").less_than(1.5).build(), "event_id", "value")


@register("SELECT doc_id, n_chars FROM documents WHERE n_chars <= 300")
def filter_le(spark, folder):
    flt = new_filter().where("n_chars").less_than_or_equal(300.9).build()
    return _where(_documents(spark, folder), flt, "doc_id", "n_chars")


@register("SELECT event_id, value FROM events WHERE value BETWEEN 10 AND 20")
def filter_between(spark, folder):
    return _where(_events(spark, folder), new_filter().where("value").in_range(10, 20).build(), "event_id", "value")


@register("SELECT event_id, value FROM events WHERE value > 10 AND value <= 20")
def filter_half_open(spark, folder):
    flt = {"range": {"key": "value", "gt": 10, "lte": 20}}
    return _where(_events(spark, folder), flt, "event_id", "value")


@register("SELECT event_id FROM events WHERE event_type = 'view'")
def filter_range_on_text(spark, folder):
    """A range on a field that is not a number matches nothing, so only the other branch does."""
    flt = filters.any_of(filters.value_range("event_type", 0), filters.value_range("ts", low=0), {"event_type": "view"})
    return _where(_events(spark, folder), flt, "event_id")


@register("SELECT doc_id, source FROM documents WHERE source = 'src1'")
def filter_text_match(spark, folder):
    return _where(_documents(spark, folder), new_filter().where("source").matches("src1").build(), "doc_id", "source")


def _tagged(spark, folder):
    tags = F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))
    return _documents(spark, folder).withColumn("tags", tags)


_TAGS = "list_distinct(string_split_regex(lower(text), '[^a-z]+'))"


@register(f"SELECT doc_id, lang FROM documents WHERE list_contains({_TAGS}, 'the')")
def filter_array_contains(spark, folder):
    return _where(_tagged(spark, folder), new_filter().where("tags").contains("the").build(), "doc_id", "lang")


@register(
    f"SELECT doc_id, lang FROM documents WHERE NOT list_has_any({_TAGS}, ['the', 'und', 'les'])"
)
def filter_array_none_of(spark, folder):
    return _where(_tagged(spark, folder), filters.none_of({"tags": ["the", "und", "les"]}), "doc_id", "lang")


@register("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'signup')")
def filter_in(spark, folder):
    return _where(_events(spark, folder), {"event_type": ["click", "signup"]}, "event_id", "event_type")


@register(
    """
    SELECT event_id, event_type, value FROM events
    WHERE event_type IN ('error', 'purchase') AND value >= 20 AND value < 60 AND user_id = 7
    """
)
def filter_shorthand(spark, folder):
    flt = {"event_type": ["error", "purchase"], "value": {"gte": 20, "lt": 60}, "user_id": 7}
    return _where(_events(spark, folder), flt, "event_id", "event_type", "value")


_K = "(props::JSON->>'$.k')::BIGINT"


@register(f"SELECT event_id FROM events WHERE {_K} = 42 OR {_K} >= 90")
def filter_json_payload(spark, folder):
    """Keys without a column are looked up in a VARIANT; the text '7' is not the number 7."""
    events = _events(spark, folder).withColumn("payload", F.parse_json("props"))
    flt = filters.any_of({"k": 42}, {"k": "7"}, filters.value_range("k", 90), {"absent": 1})
    return _where(events, flt, "event_id")


@register(f"SELECT event_id FROM events WHERE {_K} = 42 OR {_K} >= 90")
def filter_promoted_payload(spark, folder):
    """The same on a payload field that has columns of its own, written and read again."""
    events = _events(spark, folder).withColumn("payload", F.parse_json("props"))
    stored = workspace.staged(shred.promote(events, ["k"]), "promoted")
    flt = filters.any_of({"k": 42}, {"k": "7"}, filters.value_range("k", 90), {"absent": 1})
    return _where(stored, flt, "event_id")


@register(f"SELECT event_id FROM events WHERE {_K} NOT IN (1, 2, 3)")
def filter_json_negated(spark, folder):
    events = _events(spark, folder).withColumn("payload", F.parse_json("props"))
    return _where(events, filters.none_of({"k": [1, 2, 3]}, {"absent": True}), "event_id")


def _places(spark, folder):
    lon = (F.col("c_custkey") * 37 % 36000) / 100 - 180
    lat = (F.col("c_custkey") * 91 % 17000) / 100 - 85
    return table(spark, folder, "customer").withColumn("place", F.struct(lon.alias("lon"), lat.alias("lat")))


_PLACES = """
WITH c AS (SELECT c_custkey, (c_custkey * 37 % 36000) / 100.0::DOUBLE - 180 AS lon,
                  (c_custkey * 91 % 17000) / 100.0::DOUBLE - 85 AS lat FROM customer)
"""


@register(_PLACES + "SELECT c_custkey FROM c WHERE lat <= 40 AND lat >= -20 AND lon >= -150 AND lon <= 60")
def filter_geo_box(spark, folder):
    flt = new_filter().where("place").in_bounding_box({"lon": -150, "lat": 40}, {"lon": 60, "lat": -20}).build()
    return _where(_places(spark, folder), flt, "c_custkey")


@register(_PLACES + "SELECT c_custkey FROM c WHERE lat <= 60 AND lat >= -60 AND (lon >= 120 OR lon <= -160)")
def filter_geo_antimeridian(spark, folder):
    flt = new_filter().where("place").in_bounding_box({"lon": 120, "lat": 60}, {"lon": -160, "lat": -60}).build()
    return _where(_places(spark, folder), flt, "c_custkey")


def _within(lon: float, lat: float, radius: float) -> str:
    return f"""{_PLACES} SELECT c_custkey FROM c WHERE 2 * 6371000 * asin(sqrt(least(1,
      pow(sin(radians(lat - {lat}) / 2), 2)
      + cos(radians({lat})) * cos(radians(lat)) * pow(sin(radians(lon - {lon}) / 2), 2)))) <= {radius}"""


@register(_within(-100.0, 30.0, 2_500_000.0))
def filter_geo_radius(spark, folder):
    flt = new_filter().where("place").within_radius({"lon": -100.0, "lat": 30.0}, 2_500_000.0).build()
    return _where(_places(spark, folder), flt, "c_custkey")


@register(_within(175.0, -60.0, 3_000_000.0))
def filter_geo_radius_antimeridian(spark, folder):
    flt = new_filter().where("place").within_radius({"lon": 175.0, "lat": -60.0}, 3_000_000.0).build()
    return _where(_places(spark, folder), flt, "c_custkey")


@register("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND quality = 1 AND n_chars > 1000")
def filter_and(spark, folder):
    flt = new_filter().where("lang").equals("en").and_().where("quality").equals(1)
    return _where(_labelled(spark, folder), flt.where("n_chars").greater_than(1000).build(), "doc_id")


@register("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'de' OR coalesce(toxic = 1, false)")
def filter_or(spark, folder):
    flt = new_filter().where("lang").equals("de").or_().where("toxic").equals(1).build()
    return _where(_labelled(spark, folder), flt, "doc_id")


@register(
    """
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
    WHERE NOT (lang = 'en' OR coalesce(toxic = 1, false))
    """
)
def filter_not(spark, folder):
    flt = new_filter().where("lang").equals("en").where("toxic").equals(1).not_().build()
    return _where(_labelled(spark, folder), flt, "doc_id")


@register("SELECT doc_id FROM documents WHERE lang = 'en'")
def filter_single_not(spark, folder):
    """One condition alone is not negated by ``not_``."""
    return _where(_documents(spark, folder), new_filter().not_().where("lang").equals("en").build(), "doc_id")


@register("SELECT doc_id FROM documents WHERE lang = 'en' OR n_chars > 2000 OR source = 'src3'")
def filter_last_operator(spark, folder):
    """The last operator before the end joins all conditions."""
    flt = new_filter().where("lang").equals("en").and_().where("n_chars").greater_than(2000).and_().or_()
    return _where(_documents(spark, folder), flt.where("source").matches("src3").build(), "doc_id")


@register(
    """
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
    WHERE (lang IN ('en', 'fr')) AND (coalesce(quality = 1, false) OR n_chars BETWEEN 100 AND 400)
      AND NOT (source = 'src2' AND coalesce(toxic = 1, false))
    """
)
def filter_nested(spark, folder):
    flt = {
        "must": [
            {"should": [{"lang": "en"}, {"match": {"key": "lang", "value": "fr"}}]},
            {"should": [{"quality": 1}, {"range": {"key": "n_chars", "gte": 100, "lte": 400}}]},
        ],
        "must_not": [{"must": [{"source": "src2"}, {"toxic": 1}]}],
        "should": [],
    }
    return _where(_labelled(spark, folder), flt, "doc_id")


@register(
    """
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
    WHERE (lang = 'en' AND n_chars > 500) AND (coalesce(quality = 0, false) OR source = 'src5')
    """
)
def filter_combined_builders(spark, folder):
    first = new_filter().where("lang").equals("en").where("n_chars").greater_than(500)
    low, source = new_filter().where("quality").equals(0), new_filter().where("source").equals("src5")
    flt = new_filter().and_all(first).or_any(low, source, new_filter()).build()
    return _where(_labelled(spark, folder), flt, "doc_id")


@register(
    """
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS DISTINCT FROM 1 AND NOT coalesce(toxic > 0, false)
    """
)
def filter_missing_key(spark, folder):
    """Negated conditions keep the records that lack the key."""
    flt = filters.none_of({"quality": 1}, filters.value_range("toxic", low=0.5))
    return _where(_labelled(spark, folder), flt, "doc_id")


@register("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality = 1 OR toxic = 1")
def filter_double_negation(spark, folder):
    flt = filters.none_of(filters.none_of({"quality": 1}, {"toxic": 1}))
    return _where(_labelled(spark, folder), flt, "doc_id")


@register("SELECT count(*) AS count FROM documents")
def count_all(spark, folder):
    return counts.count_records(_documents(spark, folder))


@register("SELECT count(*) AS count FROM events WHERE event_type = 'purchase' AND value > 30")
def count_filtered(spark, folder):
    return counts.count_records(_events(spark, folder), {"event_type": "purchase", "value": {"gt": 30}})


@register(
    """
    SELECT count(*) AS count, 'news' AS collection, true AS has_filter, true AS exact FROM documents
    WHERE lang <> 'en' AND n_chars >= 100
    """
)
def count_memory(spark, folder):
    flt = filters.all_of(filters.none_of({"lang": "en"}), filters.value_range("n_chars", low=100))
    return counts.count_memory(_documents(spark, folder), flt, exact=True, collection="news", id_col="doc_id")


@register("SELECT count(*) AS exact, true AS close FROM events WHERE event_id NOT IN (SELECT doc_id FROM labels)")
def count_approx(spark, folder):
    """The exact count after deletions, and whether the inexact one lies within three per cent of it."""
    events = _events(spark, folder)
    left = records.delete_by_ids(events, table(spark, folder, "labels").select("doc_id"), "event_id")
    about = counts.count_records(left, exact=False, id_col="event_id").first()["count"]
    exact = counts.count_records(left)
    return exact.select(F.col("count").alias("exact"), (F.abs(F.col("count") - about) <= 0.03 * F.col("count")).alias("close"))
