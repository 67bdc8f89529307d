"""Explicit schemas: messages, the ten-column metadata export and the relational index."""

from pyspark.sql import types as T


def _s(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


_l, _i, _t = T.LongType(), T.IntegerType(), T.StringType()

PAGE = _s(page_id=_l, ns=_i, title=_t)
REVISION = _s(rev_id=_l, parent_rev_id=_l, page_id=_l, file_path=_t, offset_begin=_l, length=_l, timestamp=_t)
SITEINFO = _s(domain=_t, language_code=_t)

#: The metadata export: page and revision rows side by side, told apart by ``type``.
METADATA = _s(type=_t, page_id=_l, ns=_l, title=_t, rev_id=_l, parent_rev_id=_l, file_path=_t, offset_begin=_l, length=_l, timestamp=_t)

INDEX = {
    "containers": _s(id=_l, label=_t, wikidata_id=_t, librarybase_id=_t),
    "domains": _s(id=_l, value=_t, top_level_domain=_t, parent_domain=_l, for_container=_l, internet_domains_id=_l),
    "documents": _s(id=_l, language_code=_t, has_container=_l, part_of_larger_work=_l, title=_t, wikidata_id=_t, librarybase_id=_t),
    "web_resources": _s(id=_l, url=_t, url_hash=_t, instance_of_document=_l, availability_status=_l, is_archive_of=_l, domain_id=_l, numeric_page_id=_l, numeric_namespace_id=_l),
    "revision_bundles": _s(id=_l, file_path=_t),
    "rejected_pages": _s(file=_t, page_id=_l, ns=_l, title=_t, seq=_l),
    "revisions": _s(revision_id=_l, page_id=_l, found_in_bundle=_l, offset_begin=_l, length=_l, parent_revision_id=_l, revision_timestamp=_t),
}

#: rowTag="page" schema of a dump; numbers stay raw strings because archive headers repeat them as written.
DUMP_PAGE = T.StructType(
    [
        T.StructField("title", _t),
        T.StructField("ns", _t),
        T.StructField("id", _t),
        T.StructField(
            "revision",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", _t),
                        T.StructField("parentid", _t),
                        T.StructField("timestamp", _t),
                        T.StructField("contributor", T.StructType([T.StructField("id", _t)])),
                        T.StructField("text", T.StructType([T.StructField("_VALUE", _t)])),
                    ]
                )
            ),
        ),
    ]
)

FEED_ITEM = _s(revid=_l, pageid=_l, ns=_l, title=_t, timestamp=_t)
FEED = T.StructType(
    [
        T.StructField("query", T.StructType([T.StructField("recentchanges", T.ArrayType(FEED_ITEM))])),
        T.StructField("continue", T.StructType([T.StructField("rccontinue", _t)])),
    ]
)
CONTENT_PAGE = T.StructType(
    [
        T.StructField("ns", _l),
        T.StructField("pageid", _l),
        T.StructField(
            "revisions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("revid", _l),
                        T.StructField("parentid", _l),
                        T.StructField("timestamp", _t),
                        T.StructField("userid", _l),
                        T.StructField("slots", T.StructType([T.StructField("main", T.StructType([T.StructField("content", _t)]))])),
                    ]
                )
            ),
        ),
    ]
)
CHANGE = _s(rev_id=_l, page_id=_l, ns=_i, title=_t, timestamp=_t)
CONTENT = _s(rev_id=_l, parent_rev_id=_l, page_id=_l, ns=_i, user_id=_l, timestamp=_t, text=_t)
