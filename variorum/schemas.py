"""Explicit schemas: nothing is inferred."""

from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()


def _struct(**cols) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


BLOCK = _struct(
    type=_S, text=_S, source_pdf=_S, spread_number=_I,
    _base_fallback=_B, _ref_verified=_B, _ref_corrected=_B, _ref_unverified=_B,
    _reread_deleted=_B, _reread_unresolved=_B, _reread_recovered=_B, _reread_confirmed=_B,
)
UNCERTAIN_SPAN = _struct(q=_S, m=_S, base=_S, cat=_S)
PAGE = _struct(
    page_number=_I, page_number_inferred=_B, chapter_slug=_S, is_chapter_start=_B, is_right_page=_B,
    needs_review=_B, content_blocks=T.ArrayType(BLOCK), _uncertain=_B,
    _uncertain_spans=T.ArrayType(UNCERTAIN_SPAN), _source=_S,
)
CHAPTER = _struct(slug=_S, heading=_S, running_header=_S, first_page=_I)
REVIEW_ITEM = _struct(source_pdf=_S, spread_number=_I, estimated_pages=T.ArrayType(_I), failed_jpeg_path=_S)
DOCUMENT = _struct(
    metadata=_struct(title=_S, author=_S, translator=_S, publisher=_S, year=_I, needs_review_count=_I),
    chapters=T.ArrayType(CHAPTER),
    front_matter=T.ArrayType(_struct(type=_S, content_blocks=T.ArrayType(BLOCK))),
    pages=T.ArrayType(PAGE),
    needs_review_list=T.ArrayType(REVIEW_ITEM),
)
UNITS = _struct(book=_S, unit_no=_I, total=_I, content=_S)
CORRECTIONS = _struct(book=_S, unit_no=_I, seq=_I, pages=T.ArrayType(_I), old=_S, new=_S, rule=_S)
VERDICTS = _struct(book=_S, unit_no=_I, raw=_S)
QA_ISSUES = _struct(book=_S, page=_I, type=_S, excerpt=_S, notes=_S)
REVIEWS = _struct(key=_S, text=_S, status=_S, timestamp=T.TimestampType(), meta=_S)
