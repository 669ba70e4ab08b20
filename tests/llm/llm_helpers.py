import re
import zlib

AWKWARD = [
    None,
    "",
    " \n\t ",
    "one",
    "Two words",
    "two WORDS",
    "a b c",
    "a b c d",
    "line one\nline one\nline one\n\nlast",
    "x " * 40,
    "# * $ % & | < > symbols\r\nand\x0bmore\x0cspace",
    "Größe été ñandú 中文 字符 😀 emoji",
    " ".join(f"w{i}" for i in range(30_000)),
    " ".join(f"w{i}" for i in range(30_000)) + " end",
    "same text that stands here two times in this table ok",
    "same text that stands here two times in this table ok",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc_fold(doc_id, n=5):
    return zlib.crc32(str(doc_id).encode()) % n
