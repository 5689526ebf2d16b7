"""J6a-J6d: price-list items, hospital price lists, hospital categories and
the hospital x product-category matrix.

The reference stages four tables "for performance"; here each step is a lazy
frame and Spark plans the whole chain once.  The matrix reduces price-list
items to (price list, category) before meeting the hospitals, so its size
is hospitals x categories, not hospitals x items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from orderlens.functions.dates import valid_at
from orderlens.functions.labels import GROUP_PRICE_COUNTRIES
from orderlens.operators.joins import bounded_rows, expand_by_list, or_join
from orderlens.operators.latest import distinct_with_group_max
from orderlens.operators.pivot import pivot_flags


def pricelist_item(list_lines: DataFrame, list_headers: DataFrame, items: DataFrame, as_of, *,
                   item_ref: Column, price: Column, all_attr: str = "ALL") -> DataFrame:
    """Price-list lines valid at ``as_of`` (C10 on the header dates) with
    their item (D6: the join key is computed per attribute kind); a line
    qualifies by kind ``all_attr`` or by a found item (C12).

    ``list_lines``: header_id, price_list_id, attr (+ columns used by
    ``item_ref``/``price``); ``list_headers``: header_id, start_date,
    end_date; ``items``: item_id (+ price columns).
    Output: price_list_id, attr, item, price.
    """
    hdr = list_headers.where(valid_at("start_date", "end_date", as_of)).select("header_id")
    x = list_lines.join(hdr, "header_id", "inner")
    x = x.join(items, item_ref == items["item_id"], "left")
    x = x.where((F.col("attr") == all_attr) | F.col("item_id").isNotNull())
    return x.select("price_list_id", "attr", F.col("item_id").alias("item"), price.alias("price"))


def party_pricelist(hospitals: DataFrame, precedence: DataFrame,
                    group_countries=GROUP_PRICE_COUNTRIES, extra_cols: tuple[str, ...] = (),
                    stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Distinct (hospital_id, hospital, req, price_list_id, country).

    Hospitals in ``group_countries`` take the group price list of the
    precedence row matched by group key OR by the hospital's own key (D8,
    equi-join union, never a nested loop); the others take their site list.
    Only the first set needs the OR join at all: for the others the joined
    columns are unused and DISTINCT folds the matches back to one row.

    ``hospitals``: hospital_id, hospital, req, group_id, country,
    site_price_list (+ ``extra_cols``, kept in the DISTINCT); ``precedence``:
    grp_key, party_key, grp_price_list_id.
    """
    listed = F.coalesce(F.col("country").isin(list(group_countries)), F.lit(False))
    # both branches read the hospitals: a job passes ``stage`` (write and read back)
    # so that their input joins run once
    hospitals = stage(hospitals)
    grouped = or_join(hospitals.where(listed), precedence,
                      [("group_id", "grp_key"), ("hospital_id", "party_key")], "left")
    extra = list(extra_cols)
    out_cols = [*extra, "hospital_id", "hospital", "req", "price_list_id", "country"]
    a = grouped.select(*extra, "hospital_id", "hospital", "req",
                       F.col("grp_price_list_id").cast("bigint").alias("price_list_id"), "country")
    b = hospitals.where(~listed).select(
        *extra, "hospital_id", "hospital", "req",
        F.col("site_price_list").cast("bigint").alias("price_list_id"), "country")
    return a.unionByName(b).select(*out_cols).distinct()


def party_category(rows: DataFrame, all_items: DataFrame, all_categories: DataFrame) -> DataFrame:
    """Hospital categories = priced-item rows UNION ALL (all-items rows x
    the category list, D9), then per hospital the maxima of ``req``
    and ``price`` over distinct (hospital, category) rows (F2+E1).

    ``rows``: hid, req, price, cat; ``all_items``: hid, req;
    ``all_categories``: cat.
    """
    every = expand_by_list(all_items, all_categories.select("cat")).select(
        "hid", "req", F.lit(None).cast("double").alias("price"), "cat")
    u = rows.select("hid", "req", "price", "cat").unionByName(every)
    return distinct_with_group_max(u, "hid", ["req", "price"], ["cat"])


def _pivot_relevant(all_categories: DataFrame, categories: list[str]) -> DataFrame:
    """The all-items kind pairs a price list with EVERY category.  Categories
    outside the pivot list, and those without text, only make the hospital's
    row exist (their cells fold to 0), so one representative of them, NULL, is
    exact - at most ``len(categories) + 1`` rows, whatever the size of the
    category table."""
    listed = F.coalesce(F.col("cat").isin(list(categories)), F.lit(False))
    return all_categories.select(F.when(listed, F.col("cat")).alias("cat")).distinct()


def hospital_product(pp: DataFrame, pi: DataFrame, items: DataFrame, all_categories: DataFrame,
                     categories: list[str], *, item_attrs=("A1", "A2"), all_attr: str = "A3"
                     ) -> DataFrame:
    """J6d: one row per hospital, one 0/1 column per category.

    ``pp``: party_pricelist output; ``pi``: pricelist_item output;
    ``items``: item_id, cat; ``all_categories``: cat (bounded list for the
    all-items kind); ``categories``: pivot columns.
    """
    # One pass over the (lineitem-sized) price-list items, reduced to
    # (price list, kind, category).  The all-items kind is then expanded in
    # place: its rows explode the relevant categories (a literal list bounded
    # by the pivot width), item rows keep their own category.  No join, no
    # broadcast; the reduced frame has a single consumer.
    is_all = F.col("attr") == all_attr
    x = pi.where(F.col("attr").isin(list(item_attrs)) | is_all)
    # an item whose category has no text still counts: the match is marked
    x = x.join(items.withColumn("__hit", F.lit(True)), x["item"] == items["item_id"], "left")
    reduced = (x.where(F.col("__hit") | is_all)
                .groupBy("price_list_id", is_all.alias("__all"), "cat")
                .agg(F.max("price").alias("price")))
    # bounded by construction: the listed categories plus one for all others
    cat_type = reduced.schema["cat"].dataType
    relevant = [r["cat"] for r in bounded_rows(_pivot_relevant(all_categories, categories),
                                               len(categories) + 1, "hospital_product")]
    every = F.array(*[F.lit(c).cast(cat_type) for c in relevant]).cast(ArrayType(cat_type))
    cats = reduced.select(
        "price_list_id",
        F.explode(F.when(F.col("__all"), every).otherwise(F.array(F.col("cat")))).alias("cat"),
        F.when(~F.col("__all"), F.col("price")).alias("price"))
    u = pp.join(cats, "price_list_id", "inner").select(
        "hospital_id", "hospital", "req",
        F.when(F.col("req") == 1, F.col("price")).alias("price"), "cat")
    w = distinct_with_group_max(u, "hospital_id", ["req", "price"], ["hospital", "cat"])
    return pivot_flags(w, ["hospital_id", "hospital", "req", "price"], "cat", categories)
