"""DuckDB text of the fixture views (twins of ``imagelake.fixtures``).

Used only by ``__spark_entry__.oracle_sql`` to build the reference answers the
driver compares against. ``cte(...)`` prepends the named views as a WITH list.
"""

from __future__ import annotations

from .dims import CLASS_NAMES, PRICES_APP, PRICES_WEBCAM
from .fixtures import PAGE_CLASSES, REFERENCE_HISTORY


def _arr(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


CLASS_DIM = f"""SELECT CAST(i - 1 AS INTEGER) AS class_id, n AS name
FROM (SELECT unnest({_arr(CLASS_NAMES)}) AS n, generate_subscripts({_arr(CLASS_NAMES)}, 1) AS i)"""

PAGE_CLASS_DIM = f"""SELECT CAST(i - 1 AS INTEGER) AS class_id, n AS name
FROM (SELECT unnest({_arr(PAGE_CLASSES)}) AS n, generate_subscripts({_arr(PAGE_CLASSES)}, 1) AS i)"""


def _price_rows() -> str:
    rows = []
    for catalog, prices in (("app", PRICES_APP), ("webcam", PRICES_WEBCAM)):
        for name, text in prices.items():
            rows.append(f"('{catalog}', '{name}', '{text}', CAST('{text.split(' ')[-1]}' AS DECIMAL(6,2)))")
    return ",\n  ".join(rows)


PRICE_DIM = f"""SELECT * FROM (VALUES
  {_price_rows()}) AS t(catalog, name, price_text, price)"""

PRED_LOG = """SELECT event_id,
  concat('u', CAST(user_id AS VARCHAR), '-', strftime(ts, '%Y%m%d')) AS session_id,
  concat(event_type, '_', CAST(event_id AS VARCHAR), '.',
         CASE event_id % 20 WHEN 0 THEN 'gif' WHEN 1 THEN 'PNG' ELSE 'jpg' END) AS filename,
  CAST(event_id % 15 AS INTEGER) AS y_true,
  CAST(CASE WHEN (event_id * 31) % 100 < 8
       THEN (event_id % 15 + 1 + event_id % 14) % 15 ELSE event_id % 15 END AS INTEGER) AS y_pred,
  CAST(1048576 - ((event_id * 7919) % 1024) * ((event_id * 104729) % 1024) AS DOUBLE)
    / CAST(1048576 AS DOUBLE) AS confidence,
  event_type = 'error' AS is_error,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  CAST(ts AS TIMESTAMP) AS received_at,
  user_id, event_type,
  CAST(ts AS TIMESTAMP) + to_seconds(CAST(json_extract(props, '$.k') AS INTEGER) % 90) AS processed_at
FROM events"""

# name|confidence or error|bad image, as the scorer would encode it
OUTCOMES = """SELECT p.*, CASE WHEN p.is_error THEN 'error|bad image'
  ELSE concat_ws('|', c.name, CAST(p.confidence AS VARCHAR)) END AS outcome
FROM pred_log p LEFT JOIN class_dim c ON p.y_pred = c.class_id"""

EVAL = """SELECT event_type AS run_id, event_id AS item_id, y_true, y_pred, confidence FROM pred_log"""


def _history_literal() -> str:
    rows = []
    for m, vals in REFERENCE_HISTORY.items():
        for e, v in enumerate(vals):
            rows.append(f"('reference', {e}, '{m}', CAST({v!r} AS DOUBLE))")
    return ",\n  ".join(rows)


HISTORY = f"""SELECT * FROM (VALUES
  {_history_literal()}) AS t(run_id, epoch, metric, value)
UNION ALL
SELECT run_id, epoch, metric, value FROM (
  SELECT event_type AS run_id, CAST(dayofmonth(received_at) - 1 AS INTEGER) AS epoch,
    avg(CASE WHEN k % 2 = 0 THEN CAST(y_true = y_pred AS DOUBLE) END) AS accuracy,
    avg(CASE WHEN k % 2 = 1 THEN CAST(y_true = y_pred AS DOUBLE) END) AS val_accuracy,
    avg(CASE WHEN k % 2 = 0 THEN 1 - confidence END) AS loss,
    avg(CASE WHEN k % 2 = 1 THEN 1 - confidence END) AS val_loss
  FROM pred_log GROUP BY 1, 2
) UNPIVOT (value FOR metric IN (accuracy, val_accuracy, loss, val_loss))"""

PIX8 = """SELECT vec_id, label, 8 AS height, 8 AS width, 1 AS n_channels,
  list_transform(embedding, lambda x: CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS DOUBLE)) AS pixels
FROM embeddings"""

PIX3 = """SELECT vec_id, label, height, width, 3 AS n_channels,
  flatten(list_transform(range(0, 64), lambda i: [pixels[i + 1], pixels[(i + 21) % 64 + 1], pixels[(i + 42) % 64 + 1]])) AS pixels
FROM pix8"""

SLICES = """SELECT vec_id, CAST(s AS INTEGER) AS slice_id, embedding[s * 8 + 1 : s * 8 + 8] AS vals
FROM embeddings, range(0, 8) r(s)"""

RAW_SCORES = """SELECT vec_id AS item_id,
  list_transform(range(0, 10), lambda k:
    list_reduce(list_filter(embedding, lambda x, i: (i - 1) % 10 = k), lambda acc, x: acc + CAST(x AS DOUBLE), CAST(0.0 AS DOUBLE))) AS scores,
  label AS y_true
FROM embeddings"""

CATALOGUE = """SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path,
  CASE page_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END AS split
FROM pages"""

FRAMES = """SELECT concat('cam', CAST(user_id AS VARCHAR)) AS stream_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS frame_no,
  received_at AS ts, y_pred, confidence, is_error
FROM pred_log"""

IMAGES_FOUND = """SELECT doc_id AS object_id,
  CAST(CASE WHEN toxic = 1 THEN -1 ELSE 8 END AS INTEGER) AS height,
  CAST(CASE WHEN quality = 0 THEN 7 ELSE 8 END AS INTEGER) AS width,
  CAST(1 AS INTEGER) AS n_channels
FROM labels"""

REQUESTS = """SELECT doc_id AS object_id, concat('s', CAST(doc_id % 97 AS VARCHAR)) AS session_id,
  concat(source, '_', CAST(doc_id AS VARCHAR), '.jpg') AS filename, n_chars AS size_bytes
FROM documents"""

VIEWS = {
    "class_dim": CLASS_DIM,
    "page_class_dim": PAGE_CLASS_DIM,
    "price_dim": PRICE_DIM,
    "pred_log": PRED_LOG,
    "outcomes": OUTCOMES,
    "eval": EVAL,
    "history": HISTORY,
    "pix8": PIX8,
    "pix3": PIX3,
    "slices": SLICES,
    "raw_scores": RAW_SCORES,
    "catalogue": CATALOGUE,
    "frames": FRAMES,
    "images_found": IMAGES_FOUND,
    "requests": REQUESTS,
}

# views that other views read
DEPENDS = {
    "outcomes": ["pred_log", "class_dim"],
    "eval": ["pred_log"],
    "history": ["pred_log"],
    "pix3": ["pix8"],
    "frames": ["pred_log"],
}


def cte(*names: str) -> str:
    """WITH list holding the named views and what they read, in dependency order."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in order) + "\n"
