"""Change-data model: operation codes, ack statuses and the total order of changes.

A change row carries ``lsn`` (10-byte big-endian binary; Spark compares binary
unsigned, so byte order = log order), ``seqval`` (order inside one LSN) and ``op``.
``(lsn, seqval, op)`` is the total order everywhere; ``op`` breaks ties so that a
delete (1) sorts before an insert (2) of the same key at the same position.
"""

from __future__ import annotations

# ---- fixed values: operation codes of the change envelope -------------------------
OP_UNSPECIFIED = 0
OP_DELETE = 1
OP_INSERT = 2
OP_UPDATE_BEFORE = 3
OP_UPDATE_AFTER = 4
OP_NAMES = {
    0: "UNSPECIFIED",
    1: "DELETE",
    2: "INSERT",
    3: "UPDATE_OLD",
    4: "UPDATE_NEW",
}

# ---- fixed values: acknowledgement statuses ----------------------------------------
ACK_OK = "OK"
ACK_PARTIAL = "PARTIAL"
ACK_RETRY = "RETRY"
ACK_FAILED = "FAILED"
ACK_SCHEMA_MISMATCH = "SCHEMA_MISMATCH"
# statuses after which the cursor moves to the acknowledged LSN
ADVANCING_STATUSES = (ACK_OK, ACK_PARTIAL)

# ---- fixed value: idle poll interval -----------------------------------------------
DEFAULT_POLL_INTERVAL_MS = 1000

LSN_BYTES = 10
ORDER_COLS = ("lsn", "seqval", "op")
ENVELOPE_KEY = ("source", "schema_name", "table_name")

UPSERT_OPS = (OP_INSERT, OP_UPDATE_AFTER)
APPLIED_OPS = (OP_DELETE, OP_INSERT, OP_UPDATE_AFTER)
