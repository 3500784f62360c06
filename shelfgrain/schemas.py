"""Declared schemas of the logical tables and of the payloads with a fixed shape."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

FACT_REVIEWS = _struct(review_uid=S, content=S, star=I)
PREDICTED_REVIEWS = _struct(review_uid=S, content=S, star=I, true_label=S, pred_label=S, is_correct=B, run_date=T.DateType())
CONFORMED_REVIEWS = _struct(review_uid=S, source=S, product_id=S, content=S, star=I, created_at=T.TimestampType())
CONFORMED_PRODUCTS = _struct(
    product_id=S, source=S, name=S, brand=S, price=L, rating=D, review_count=L, category=S, product_url=S
)
PRODUCT_DOCUMENT = _struct(product_id=S, name=S, brand=_struct(name=S), price=D, categories=T.ArrayType(S))

# every leaf of the ranking payload is read as its JSON text and cast where it is used
_EVENT = _struct(eventLog=_struct(amplitude=_struct(payload=_struct(reviewCount=S, reviewScore=S))))
_CLICK = T.StructType([T.StructField("url", S), *_EVENT.fields])
_TEXTS = T.ArrayType(_struct(text=S))
RANKING_ITEM = _struct(
    type=S,
    id=S,
    info=_struct(productName=S, brandName=S, finalPrice=S, discountRatio=S, additionalInformation=_TEXTS),
    image=_struct(url=S, labels=_TEXTS, onClickLike=_EVENT),
    onClick=_CLICK,
)
RANKING_PAYLOAD = _struct(data=_struct(modules=T.ArrayType(_struct(type=S, items=T.ArrayType(RANKING_ITEM)))))
