"""Listing text, first-row selection and chat prompts, for all requests at once.

A prompt is built per request ``(house_id, wish_id)``: requests are the input,
so a buyer scoring every listing passes one request per listing (see
``requests_for_wish``) and no pair is ever generated by a cross join.

SURVEY IDs: M1, M3, M4, M7, W1, W2, F5 (batch form).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.text import col_, py_float_str, py_strip

# Listing fields and their labels, in rendering order.
FIELD_LABELS = [
    ("title", "标题"),
    ("district", "区县"),
    ("community", "小区"),
    ("position", "位置"),
    ("total_price", "总价"),
    ("unit_price", "单价"),
    ("house_type", "户型"),
    ("house_size", "面积"),
    ("direction", "朝向"),
    ("fitment", "装修"),
    ("level", "楼层"),
    ("build_type", "建筑类型"),
]
# Units appended to a value, the separators, and the missing mark.
FIELD_UNITS = {"total_price": "万", "unit_price": "元/平"}
LABEL_SEP = ": "
FIELD_SEP = "，"
MISSING = "-"

# Prompt texts.
SYSTEM_PROMPT = (
    "# 目标"
    "\n你是一个房产专家，根据房屋信息和用户需求，给出满意分（最高100分）简明阐述对应打分依据"
    "\n - 如果不满足用户预期，分值不超过50分"
    "\n# 示例"
    "\n-满意分: 85分。根据用户需求来看，户型图南北通透、依据房屋图房间装修干净简洁、总价在用户预期内"
    "\n-满意分: 30分。根据用户需求来看，户型不够方正、房子建设时间较久、房子装修较差"
)
WISH_HEADER = "# 用户需求\n"
INFO_HEADER = "# 房源信息\n"
PLANS_MARKER = "以下是户型图"
ROOMS_MARKER = "以下是各个房间的图"


def value_text(df: DataFrame, name: str) -> Column:
    """A field as Python would print it; '-' when the column or the value is missing."""
    if name not in df.columns:
        return F.lit(MISSING)
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        txt = py_float_str(c)
    elif isinstance(dt, T.StringType):
        txt = c
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(MISSING))


def base_info(df: DataFrame, fields=FIELD_LABELS) -> Column:
    """``标题: x，区县: y，...，总价: 98.0万，单价: 12000.0元/平，...``"""
    parts = [F.concat(F.lit(label + LABEL_SEP), value_text(df, name),
                      F.lit(FIELD_UNITS.get(name, "")))
             for name, label in fields]
    return F.concat_ws(FIELD_SEP, *parts)


def first_per_key(df: DataFrame, key, order, where: Column | None = None) -> DataFrame:
    """The first row of each key by ``order`` (optionally among rows meeting ``where``).

    ``row_number() = 1`` is planned as a WindowGroupLimit that also runs before
    the shuffle, so a key holding a third of the rows sends one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    src = df if where is None else df.filter(where)
    w = Window.partitionBy(*keys).orderBy(*[col_(o) for o in orders])
    return src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


_PART = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
                      T.StructField("image_url", T.StructType([T.StructField("url", T.StringType())]))])


def text_part(text) -> Column:
    return F.struct(F.lit("text").alias("type"), col_(text).cast("string").alias("text"),
                    F.lit(None).cast("struct<url:string>").alias("image_url"))


def image_part(uri) -> Column:
    return F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                    F.struct(col_(uri).alias("url")).alias("image_url"))


def gallery_parts(plan_uris, room_uris) -> Column:
    """Plan marker, plan images, room marker, room images (markers always present)."""
    return F.concat(F.array(text_part(F.lit(PLANS_MARKER))),
                    F.transform(col_(plan_uris), image_part),
                    F.array(text_part(F.lit(ROOMS_MARKER))),
                    F.transform(col_(room_uris), image_part))


def messages(wish, info, has_gallery, plan_uris, room_uris) -> Column:
    """System message, then the user message: wish (when given), listing text,
    and the gallery parts when the listing has a gallery."""
    w = py_strip(col_(wish))
    wish_part = F.when(F.coalesce(w, F.lit("")) != "",
                       F.array(text_part(F.concat(F.lit(WISH_HEADER), w))))
    user = F.concat(
        F.coalesce(wish_part, F.array().cast(T.ArrayType(_PART))),
        F.array(text_part(F.concat(F.lit(INFO_HEADER), F.coalesce(col_(info), F.lit(""))))),
        F.when(col_(has_gallery), gallery_parts(plan_uris, room_uris))
        .otherwise(F.array().cast(T.ArrayType(_PART))),
    )
    system = F.struct(F.lit("system").alias("role"),
                      F.array(text_part(F.lit(SYSTEM_PROMPT))).alias("content"))
    return F.array(system, F.struct(F.lit("user").alias("role"), user.alias("content")))


def messages_json(msgs) -> Column:
    """Chat messages as JSON; null fields are left out, as in the hand-built dicts."""
    return F.to_json(col_(msgs))


def requests_for_wish(listings: DataFrame, wish_id: int, key: str = "house_id") -> DataFrame:
    """One request per distinct listing for a single wish (a projection, no join)."""
    return listings.select(key).distinct().withColumn("wish_id", F.lit(wish_id).cast("bigint"))


def listing_cards(final: DataFrame, key: str = "house_id", order: str = "seq") -> DataFrame:
    """Per listing: text of its first row and its first non-empty gallery.

    One aggregation, partial before the shuffle; ``min_by`` skips rows whose
    ordering value is null, which is how rows without a gallery are passed
    over.  The text is rendered after the aggregation, once per listing.
    """
    has_gallery = "gallery" in final.columns
    fields = [c for c, _ in FIELD_LABELS if c in final.columns]
    aggs = [F.min_by(F.struct(*fields), F.col(order)).alias("_first")]
    if has_gallery:
        g_order = F.when(F.size("gallery") > 0, F.col(order))
        aggs.append(F.min_by(F.col("gallery"), g_order).alias("gallery"))
    first = final.groupBy(key).agg(*aggs).select(key, "_first.*", *(["gallery"] if has_gallery else []))
    out = first.select(key, base_info(first).alias("info"),
                       *(["gallery"] if has_gallery else []))
    if not has_gallery:
        out = out.withColumn("gallery", F.lit(None).cast("array<struct<pos:int,url:string,descr:string>>"))
    return out


def listing_views(requests: DataFrame, final: DataFrame, key: str = "house_id",
                  preview: tuple[str, str] | None = ("450x300", "210x140"),
                  max_num: int = 8) -> DataFrame:
    """Per requested listing: its text, and the URLs of up to ``max_num`` plan and room images.

    The batch form of looking up one listing for display; URLs are rewritten
    to the preview size when ``preview`` is given.
    """
    from hearth.functions.images import resize_thumb
    from hearth.operators.gallery import kind, no_images

    cards = listing_cards(final.join(requests.select(key).distinct(), key, "left_semi"), key)

    def urls(plans: bool):
        u = F.transform(kind("gallery", plans, max_num), lambda x: x["url"])
        if preview:
            u = F.transform(u, lambda x: resize_thumb(x, *preview))
        return no_images(u)

    return cards.select(key, "info", urls(True).alias("plan_urls"), urls(False).alias("room_urls"))


def listing_view(final: DataFrame, house_id: int, key: str = "house_id",
                 preview: tuple[str, str] | None = ("450x300", "210x140"), max_num: int = 8) -> DataFrame:
    """One listing for display; the id filter is pushed down to the stage's files."""
    one = final.filter(F.col(key) == F.lit(house_id))
    return listing_views(one.select(key), one, key, preview, max_num)


def build_prompts(requests: DataFrame, wishes: DataFrame, final: DataFrame,
                  images: DataFrame | None = None, key: str = "house_id") -> DataFrame:
    """requests(house_id, wish_id) -> prompts(house_id, wish_id, messages).

    Unknown listings get an empty listing text and no gallery; unknown wishes
    get no wish part.  Image bytes are attached only for the listings asked for.
    """
    from hearth.operators.gallery import attach_images, no_images

    # render only the listings asked for
    asked = listing_cards(final.join(requests.select(key).distinct(), key, "left_semi"), key)
    if images is not None:
        asked = attach_images(asked, images, key, carry=("info", "gallery"))
    else:
        asked = asked.select("*", F.lit(None).cast("array<string>").alias("plan_uris"),
                             F.lit(None).cast("array<string>").alias("room_uris"))
    # a request asked twice is answered once (each prompt is a paid call)
    rows = (requests.select(key, "wish_id").distinct()
            .join(one_wish_per_id(wishes), "wish_id", "left")
            .join(asked, key, "left"))
    msgs = messages(F.col("user_input"), F.col("info"), F.col("gallery").isNotNull(),
                    no_images(F.col("plan_uris")), no_images(F.col("room_uris")))
    return rows.select(key, "wish_id", msgs.alias("messages"))


def one_wish_per_id(wishes: DataFrame) -> DataFrame:
    """``(wish_id, user_input, texts)``: of several texts for one id the least, and how many there are."""
    return wishes.groupBy("wish_id").agg(F.min("user_input").alias("user_input"),
                                         F.count(F.lit(1)).alias("texts"))
