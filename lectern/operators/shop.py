"""Grade and open distributions, orders, and enterprise reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grade_distribution(modules: DataFrame) -> DataFrame:
    """How often each (grade, max_grade) was given in a module."""
    return modules.where("grade IS NOT NULL").groupBy("course_id", "module_id", "grade", "max_grade").agg(F.count("*").alias("count"))


def sequential_open_distribution(modules: DataFrame) -> DataFrame:
    return modules.where("module_type = 'sequential'").groupBy("course_id", "module_id").agg(F.count("*").alias("count"))


def orders_best_price(lines: DataFrame) -> DataFrame:
    return lines.where("NOT refunded").groupBy("user_id", "course_id", "uuid").agg(F.max("price").alias("price"))


def order_line_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.count("*").alias("line_count"))


def last_activity(activity: DataFrame, *keys: str) -> DataFrame:
    return activity.groupBy(*keys).agg(F.max("date").alias("last_activity_date"))


def offer_text(kind: str = "benefit_type", value: str = "benefit_value"):
    number = F.format_string("%.2f", value)
    return F.when(F.col(kind) == "Percentage", F.concat(number, F.lit("%"))).when(F.col(kind) == "Absolute", F.concat(F.lit("$"), number))


def product_uuids(products: DataFrame, attributes: DataFrame, values: DataFrame, code: str = "UUID") -> DataFrame:
    """Products with the text of one attribute, null where a product has none. The attribute is a constant of the join:
    it is looked up first, and filters the values before they meet the products."""
    own = values.join(attributes.where(F.col("code") == code).select(F.col("id").alias("attribute_id")), "attribute_id", "left_semi")
    return products.join(own.select("product_id", F.col("value_text").alias("uuid")), "product_id", "left")


def lines_at_best_price(lines: DataFrame, best: DataFrame) -> DataFrame:
    """Lines that cost what the user's best line of the same course, or else of the same uuid, did. Equality on user and
    price carries the join; course or uuid is what is left to test. lines: order_id, user_id, course_id, uuid, price."""
    b = best.select("user_id", "price", F.col("course_id").alias("best_course"), F.col("uuid").alias("best_uuid"))
    df = lines.join(b, ["user_id", "price"]).where((F.col("course_id") == F.col("best_course")) | (F.col("uuid") == F.col("best_uuid")))
    return df.select("order_id", "user_id", "course_id", "uuid", "price", "best_course", "best_uuid").distinct()


def newest_social(social: DataFrame) -> DataFrame:
    """The account of the largest id of each user; its name is what follows the last colon."""
    return social.groupBy("user_id").agg(F.max_by("uid", "id").alias("uid")).select("user_id", F.substring_index("uid", ":", -1).alias("user_sso_id"))


def enterprise_enrollment(links: DataFrame, customers: DataFrame, people: DataFrame, summary: DataFrame, grades: DataFrame, activity: DataFrame, courses: DataFrame, social: DataFrame, prices: DataFrame, discounts: DataFrame) -> DataFrame:
    """A row for each enterprise course enrollment, in named steps: who, what, how it went, and what it cost.

    links: enterprise_id, user_id, course_id. prices: best price by user, course and uuid. discounts: user_id, course_id,
    benefit_type, benefit_value, used by those with a price.
    """
    who = links.join(customers, "enterprise_id").join(people.select("user_id", "username", "name"), "user_id").join(newest_social(social), "user_id", "left")
    what = who.join(summary.select("user_id", "course_id", "current_enrollment_mode", "current_enrollment_is_active", "first_enrollment_time"), ["user_id", "course_id"])
    what = what.join(courses, "course_id", "left")
    went = what.join(grades.select("user_id", "course_id", "letter_grade", "passed_timestamp"), ["user_id", "course_id"], "left").join(last_activity(activity, "user_id", "course_id"), ["user_id", "course_id"], "left")
    cost = went.join(prices.select("user_id", "course_id", "price"), ["user_id", "course_id"], "left").join(discounts, ["user_id", "course_id"], "left")
    paid = F.when(F.col("benefit_type") == "Percentage", F.col("price") * (1 - F.col("benefit_value") / 100)).when(F.col("benefit_type") == "Absolute", F.col("price") - F.col("benefit_value")).otherwise(F.col("price"))
    return cost.select(
        "enterprise_id", "enterprise_name", "user_id", "username", "user_sso_id", "course_id", "course_title",
        F.ceil(F.datediff("course_end", "course_start") / 7).cast("long").alias("course_duration_weeks"), F.col("current_enrollment_mode").alias("user_current_enrollment_mode"),
        F.col("current_enrollment_is_active").alias("is_active"), F.col("first_enrollment_time").alias("enrollment_created"),
        (F.coalesce(F.col("letter_grade") != "", F.lit(False)) & F.col("passed_timestamp").isNotNull()).alias("has_passed"), "last_activity_date",
        F.round("price", 2).alias("course_price"), F.round(F.greatest(paid, F.lit(0.0)), 2).alias("discount_price"), offer_text().alias("offer"),
    ).distinct()


def enterprise_user(links: DataFrame, customers: DataFrame, people: DataFrame, social: DataFrame, activity: DataFrame) -> DataFrame:
    df = links.select("enterprise_id", "user_id").join(customers, "enterprise_id").join(people.select("user_id", "username", "name"), "user_id")
    df = df.join(newest_social(social), "user_id", "left").join(last_activity(activity, "user_id"), "user_id", "left")
    return df.select("enterprise_id", "enterprise_name", "user_id", "user_sso_id", "username", "last_activity_date").distinct()
