"""Plain versions of the operators, and tables with the odd rows each of them must stand."""

import re

import pyarrow as pa
import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, schema=DOCS):
    """Documents from (id, text), with columns no operator asks for and whose names they use inside."""
    full = [(i, t, "en", "s", None if t is None else len(t), 7, "x", 1, 2, 3) for i, t in rows]
    more = ", fp long, anchor string, slot int, shard int, start int"
    return spark.createDataFrame(full, schema + more).repartition(3)


def odd_documents():
    """Null and empty texts, null and equal ids, equal texts, white space of all kinds, a very long word and text."""
    line = "This line stands in several documents of the table."
    long_text = " ".join(f"word{i % 997} and" for i in range(20_000))
    return [
        (1, None), (2, ""), (3, " \t\r\n"), (4, line), (5, f"  {line.upper()}\t\n{line}\nother"), (6, f"{line}\n\n end"),
        (7, long_text), (8, long_text + " more"), (9, "x" * 30_000), (10, "Ünïcode Ωμέγα ΑΣ 中文 👍🏽 é    İ"), (11, "a\x00b \x1c c\x85d"),
        (12, line), (12, line), (12, "another text under the same id"), (None, line), (None, None), (None, "no id here"),
        (13, "<|endoftext|> in <|startoftext|>a text"), (14, "a a a a a a a a"), (15, "don't we'll 12345 ...!!! #$%"),
    ]


def lines_by_hand(rows, min_chars=20, min_docs=3):
    held = {}
    keyed = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(" \t\n\x0b\f\r").translate(LOWER) for x in lines]
        keyed.append((doc_id, lines, keys))
        for key in set(keys):
            held.setdefault(key, []).append(-(1 << 63) if doc_id is None else doc_id)
    result = []
    for doc_id, lines, keys in keyed:
        own = -(1 << 63) if doc_id is None else doc_id
        stays = [
            x for x, k in zip(lines, keys)
            if len(k) < min_chars or len(held[k]) < min_docs or max(held[k]) == own
        ]
        result.append((doc_id, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return result


def write_table(folder, name, table: pa.Table):
    path = folder / f"{name}.parquet"
    path.mkdir(parents=True)
    pq.write_table(table, path / "part-0.parquet")
