"""Common table expressions shared by the SQL checks (DuckDB dialect)."""

from __future__ import annotations

from ledgerloom.functions import text

# The same character classes as the Column expressions, as SQL text.
STRIP_CHARS = "||".join(f"chr({ord(c)})" for c in text.WHITESPACE)
SPACE_RUN = text.WHITESPACE_CLASS + "+"
INVISIBLE = text.INVISIBLE_CLASS
FORBIDDEN = text.FORBIDDEN_CLASS
MARKDOWN = text.MARKDOWN_CLASS


def strip(x: str) -> str:
    return f"trim({x}, {STRIP_CHARS})"


def bounded(x: str, max_chars: int = 8000) -> str:
    s = strip(f"replace({x}, chr(0), '')")
    return (
        f"CASE WHEN length({s}) <= {max_chars} THEN {s} "
        f"ELSE left({s}, {max_chars - 20}) || chr(10) || '[truncated locally]' END"
    )


def truncated(x: str, n: int) -> str:
    """Longest prefix of whole characters in n - 3 bytes, right-stripped, with an ellipsis."""
    if n < 3:
        return f"CASE WHEN strlen({x}) <= {n} THEN {x} ELSE '' END"
    fit = (
        f"list_max(list_filter(range({(n - 3) // 4}, {n - 2}), "
        f"lambda i: strlen(left({x}, i)) <= {n - 3}))"
    )
    return f"CASE WHEN strlen({x}) <= {n} THEN {x} ELSE rtrim(left({x}, {fit}), {STRIP_CHARS}) || '…' END"


def escaped(x: str) -> str:
    html = f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"regexp_replace({html}, '{MARKDOWN}', '\\\\\\1', 'g')"


def one_line(x: str) -> str:
    return strip(f"regexp_replace({x}, '{SPACE_RUN}', ' ', 'g')")


def escaped_line(x: str) -> str:
    return escaped(one_line(f"regexp_replace({x}, '{INVISIBLE}', '', 'g')"))


EVENT_LINES = """
event_lines AS (
  SELECT conv_id, turn, role, text, captured_at, source, line,
         CAST(sum(strlen(line)) OVER (PARTITION BY source ORDER BY conv_id, turn) AS BIGINT) AS byte_end,
         CAST(sum(strlen(line)) OVER (PARTITION BY source ORDER BY conv_id, turn) AS BIGINT)
           - strlen(line) AS byte_start
  FROM (
    SELECT *, json_object('timestamp', captured_at, 'type', 'response_item', 'payload',
        CASE WHEN turn = 0 THEN json_object('type', 'message', 'role', role, 'content', text)
             WHEN role = 'user' THEN json_object('type', 'message', 'role', role, 'content',
               json_array(json_object('type', 'input_text', 'text', text)))
             WHEN role = 'assistant' THEN json_object('type', 'message', 'role', role, 'content',
               json_array(json_object('type', 'output_text', 'text', text),
                          json_object('type', 'reasoning', 'text', text)))
             ELSE json_object('type', 'message', 'role', role, 'content', json_object('text', text))
        END)::VARCHAR || chr(10) AS line
    FROM (
      SELECT *, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(conv_id * 37 + turn AS BIGINT)),
                         '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
             printf('log-%06d-%03d.jsonl', conv_id // 16, turn // 1000) AS source
      FROM conversations)))
"""

LEDGER = EVENT_LINES + f""",
texts AS (
  SELECT *, {bounded('text')} AS body FROM event_lines WHERE role IN ('user', 'assistant')),
refs AS (
  SELECT *, left(sha256('source-log-v1' || chr(0) || source), 16) AS source_ref,
         sha256(line) AS event_sha256
  FROM texts WHERE body <> ''),
ledger AS (
  SELECT conv_id, turn, source, sha256('ledger-record-v1' || chr(0) || source_ref || chr(0) || byte_start
           || chr(0) || byte_end || chr(0) || event_sha256) AS record_id,
         captured_at, role, body AS text, sha256(body) AS text_sha256,
         source_ref, byte_start, byte_end, event_sha256
  FROM refs)
"""

DAILY = LEDGER + """,
daily AS (
  SELECT *, CAST(timezone('Asia/Seoul', CAST(captured_at AS TIMESTAMPTZ)) AS DATE) AS day
  FROM ledger)
"""

# The recursive part walks each day in order and opens a new batch when the next
# row would pass a bound; `seq` numbers the rows of a day.
DIGEST = DAILY + f""",
excerpts AS (
  SELECT *, {truncated('line1', 480)} AS excerpt
  FROM (SELECT *, {escaped_line('text')} AS line1,
               row_number() OVER (PARTITION BY day ORDER BY captured_at, record_id) AS seq FROM daily)),
running AS (
  SELECT *, sum(strlen(excerpt)) OVER (PARTITION BY day ORDER BY seq) AS used
  FROM excerpts WHERE seq <= 80),
digest_items AS (SELECT * FROM running WHERE used <= 24000)
"""


def with_(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.strip()}\n{select}"
