"""The enterprise report: every course enrollment that an organisation made, how it went, and what was paid for it.

Each step is a DataFrame of its own: lines that stand, the user's best line of a course, what an order was discounted by, and
the course that an entitlement was used for. Side tables are brought to one row for each key before they are joined, so no
join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shop import newest_social, product_uuids

#: The provider whose accounts name a learner, and the status of refunds that took a line back.
PROVIDER, REFUNDED = "tpa-saml", "Complete"


def standing_lines(lines: DataFrame, refunds: DataFrame) -> DataFrame:
    """The lines without a refund, or with one at least that isn't complete."""
    per_line = refunds.groupBy(F.col("order_line_id").alias("id")).agg(F.max(F.coalesce(F.col("status") != REFUNDED, F.lit(False))).alias("stands"))
    return lines.join(per_line, "id", "left").where(F.coalesce("stands", F.lit(True))).drop("stands")


def offer_name() -> Column:
    """What an offer takes off, in words; vouchers have names of their own."""
    said = F.when(F.col("proxy_class").isNull(), F.col("benefit_type")).when(F.col("proxy_class").contains("Percentage"), "Percentage").otherwise("Absolute")
    return F.when(F.col("offer_id").isNotNull() & ~F.coalesce(F.col("offer_type") == "Voucher", F.lit(False)), F.concat(said, F.lit(", "), "benefit_value", F.lit(" (#"), F.col("offer_id").cast("string"), F.lit(")")))


def order_discounts(discounts: DataFrame, vouchers: DataFrame, offers: DataFrame, benefits: DataFrame) -> DataFrame:
    """order_id, coupon_name, coupon_code, offer of each discount."""
    v = vouchers.select(F.col("id").alias("voucher_id"), F.col("name").alias("coupon_name"), F.col("code").alias("coupon_code"))
    b = benefits.select(F.col("id").alias("benefit_id"), "proxy_class", F.col("type").alias("benefit_type"), F.col("value").alias("benefit_value"))
    o = offers.select(F.col("id").alias("offer_id"), "offer_type", "benefit_id").join(b, "benefit_id", "left")
    df = discounts.join(v, "voucher_id", "left").join(o.withColumn("known", F.col("offer_id")), "offer_id", "left").withColumn("offer_id", F.col("known"))
    return df.select("order_id", "coupon_name", "coupon_code", offer_name().alias("offer")).distinct()


def course_orders(t: dict[str, DataFrame]) -> DataFrame:
    """username, course_id, course_price, discount_price, offer, coupon_name, coupon_code of each user's best line of a course.

    A line counts if it cost what the user's dearest line that stands did, of the same course or of the same product id;
    a product without a course takes the one of the enrollment that its entitlement was used for. The order's total
    is the price paid if the line is its only one.
    """
    products = product_uuids(t["products"].withColumnRenamed("id", "product_id"), t["attributes"], t["attribute_values"])
    orders = t["shop_orders"].where("user_id IS NOT NULL").select(F.col("id").alias("order_id"), "number", "user_id", "total")
    # A line without a price is no best line, nor does it cost what one did. Both readers of the lines need the same rows and columns, so that one set of exchanges serves them.
    lines = standing_lines(t["order_lines"].where("price IS NOT NULL"), t["refunds"]).join(products, "product_id").join(orders.select("order_id", "user_id"), "order_id")
    best = lines.groupBy("user_id", F.col("course_id").alias("best_course"), F.col("uuid").alias("best_uuid")).agg(F.max("price").alias("price"))
    chosen = lines.join(best, ["user_id", "price"]).where((F.col("course_id") == F.col("best_course")) | (F.col("uuid") == F.col("best_uuid")))
    # Dealt by order once: rows become distinct there, and meet what is known of the order.
    chosen = chosen.select("order_id", "user_id", "course_id", "best_uuid", "price").repartition("order_id").distinct()
    counts = t["order_lines"].groupBy("order_id").agg(F.count("*").alias("n_lines"))
    used = t["entitlements"].where("enrollment_id IS NOT NULL").select("enrollment_id", F.col("course_uuid").alias("bare_uuid"), F.col("order_number").alias("number"))
    used = used.join(t["enrollments"].select(F.col("id").alias("enrollment_id"), F.col("course_id").alias("used_course")), "enrollment_id")
    used = used.groupBy("number").agg(F.collect_set(F.struct("bare_uuid", "used_course")).alias("used"))  # at most the order's entitlements
    known = orders.join(t["shop_users"].select(F.col("id").alias("user_id"), "username"), "user_id").join(used, "number", "left").withColumnRenamed("user_id", "buyer").drop("number")
    df = chosen.join(known, "order_id").where("user_id = buyer").join(counts, "order_id", "left")
    df = df.join(order_discounts(t["discounts"], t["vouchers"], t["offers"], t["benefits"]), "order_id", "left")
    bare = F.replace("best_uuid", F.lit("-"), F.lit(""))
    df = df.withColumn("used_course", F.explode_outer(F.transform(F.filter("used", lambda x: x["bare_uuid"] == bare), lambda x: x["used_course"])))
    paid = F.when(F.coalesce(F.col("n_lines") > 1, F.lit(False)), None).otherwise(F.col("total"))
    return df.select("username", F.coalesce("course_id", "used_course").alias("course_id"), F.col("price").alias("course_price"), paid.alias("discount_price"), "offer", "coupon_name", "coupon_code").where("course_id IS NOT NULL").distinct()


def enterprise_report(t: dict[str, DataFrame]) -> DataFrame:
    """The report's rows. Tables by name, beside those of ``course_orders``: customers (uuid, name, site_id), customer_users (id,
    user_id, enterprise_id, linked), course_links (customer_user_id, course_id), users, summary, activity, consent, grades,
    social (id, user_id, provider, uid) and courses."""
    key = ["user_id", "course_id"]
    linked = t["customer_users"].where("linked = 1").select(F.col("id").alias("enterprise_user_id"), "user_id", "enterprise_id")
    customers = t["customers"].select(F.col("uuid").alias("enterprise_id"), F.col("name").alias("enterprise_name"), F.col("site_id").alias("enterprise_site_id"))
    who = t["course_links"].withColumnRenamed("customer_user_id", "enterprise_user_id").join(linked, "enterprise_user_id").join(customers, "enterprise_id")
    people = t["users"].select(F.col("id").alias("user_id"), F.col("username").alias("user_username"), F.col("email").alias("user_email"), F.col("date_joined").alias("user_account_creation_timestamp"), F.col("country").alias("user_country_code"))
    who = who.join(people, "user_id").join(newest_social(t["social"].where(F.col("provider") == PROVIDER)).withColumnRenamed("user_sso_id", "enterprise_sso_uid"), "user_id", "left")
    courses = t["courses"].withColumnsRenamed({"catalog_course_title": "course_title", "start_time": "course_start", "end_time": "course_end", "pacing_type": "course_pacing_type", "min_effort": "course_min_effort", "max_effort": "course_max_effort", "catalog_course": "course_key"})
    what = who.join(courses, "course_id").join(t["enrollments"].select(*key, F.col("created").alias("enrollment_created_timestamp"), F.col("mode").alias("user_current_enrollment_mode")), key)
    what = what.join(t["summary"].select(*key, F.col("last_unenrollment_time").alias("unenrollment_timestamp")), key, "left").join(t["activity"].groupBy(*key).agg(F.max("date").alias("last_activity_date")), key, "left")
    grades = t["grades"].select(*key, "letter_grade", F.col("percent_grade").alias("current_grade"), "passed_timestamp")
    went = what.join(grades, key, "left").join(t["consent"].select(F.col("username").alias("user_username"), "course_id", F.col("granted").alias("consent_granted")), ["user_username", "course_id"], "left")
    cost = went.join(course_orders(t).withColumnRenamed("username", "user_username"), ["user_username", "course_id"], "left")
    weeks = F.when(F.col("course_pacing_type") == "self_paced", F.col("weeks_to_complete").cast("string")).otherwise(F.ceil(F.datediff("course_end", "course_start") / 7).cast("string"))
    passed = F.coalesce(F.col("passed_timestamp").isNotNull() & (F.col("letter_grade") != ""), F.lit(False)).cast("int")
    return cost.withColumns({"course_duration_weeks": weeks, "has_passed": passed}).select(
        "enterprise_id", "enterprise_name", F.col("user_id").alias("lms_user_id"), "enterprise_user_id", "course_id", "enrollment_created_timestamp", "user_current_enrollment_mode", "consent_granted", "letter_grade", "has_passed", "passed_timestamp",
        "enterprise_sso_uid", "enterprise_site_id", "course_title", "course_start", "course_end", "course_pacing_type", "course_duration_weeks", "course_min_effort", "course_max_effort", "user_account_creation_timestamp", "user_email", "user_username",
        "course_key", "user_country_code", "last_activity_date", "coupon_name", "coupon_code", "offer", "current_grade", "course_price", "discount_price", "unenrollment_timestamp",
    ).distinct()
