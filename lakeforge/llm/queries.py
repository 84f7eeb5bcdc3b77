"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op6_byte_bpe
from .centroids import op13_centroids
from .centroids import sql as centroids_sql
from .chat import op2_chat_format
from .class_lm import op11_class_lm
from .decontamination import op3_decontamination
from .filter_audit import SQL as FILTER_AUDIT_SQL
from .filter_audit import op12_filter_audit
from .lang_id import op1_language_id
from .media import op7_media
from .ngram_join import op5_ngram_join
from .quality import op10_quality
from .secrets_scan import op8_secrets
from .toxicity import op4_toxicity
from .warc import op9_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_language_id, op2_chat_format, op3_decontamination, op4_toxicity, op5_ngram_join, op6_byte_bpe, op7_media, op8_secrets, op9_warc, op10_quality, op11_class_lm, op12_filter_audit, op13_centroids)
    return {f.__name__: f for f in found}


# These keep whole-table semantics; the other operators can't be expressed in SQL and are tested against plain versions.
ORACLE_SQL = {
    "op12_filter_audit": FILTER_AUDIT_SQL,
    "op13_centroids": centroids_sql(),
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
        m AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
               CASE WHEN m.last IS NOT NULL AND m.last <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN m.last <> d.page_id THEN m.last END AS refers_to
        FROM d LEFT JOIN m ON d.payload_bytes >= 1000 AND d.payload_digest = m.payload_digest""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
