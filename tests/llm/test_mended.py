"""Cases that the numbered operators once got wrong, and plain versions of their inner choices."""

import base64
import time
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from lakekit.llm.common import materialize, read
from lakekit.llm.mixing import count_words, mix_sources, plan_mix
from lakekit.llm.secrets import is_key, is_openssh_key, secret_spans
from lakekit.llm.substring_dedup import remove_repeats

SF = "/root/testdata/sf0.001"


# 2


def sized(docs):
    return materialize(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")), "t")


def plain_taken(rows, block_words):
    """taken of each row by walking a shard's blocks in their order of choice; rows are one shard's, by first_word."""
    sizes = [r.size for r in rows]
    words = [i for i, n in enumerate(sizes) for _ in range(n)]  # the row of each word
    blocks = [words[i : i + block_words] for i in range(0, len(words), block_words)]
    quota = sum(r.taken for r in rows)
    taken = Counter()
    for _ in range(quota // len(words)):
        taken.update(words)
    rest = quota % len(words)
    for j in sorted(range(len(blocks)), key=lambda j: (j * rows[0].step + rows[0].shift) % len(blocks)):
        taken.update(blocks[j][:rest])
        rest = max(0, rest - len(blocks[j]))
    return [taken[i] for i in range(len(rows))]


@pytest.mark.parametrize("block_words", [64, 7, 1])
def test_mix_equals_plain_selection(spark, block_words):
    docs = read(spark, SF, "documents")
    shards, targets = defaultdict(list), {}
    for r in plan_mix(sized(docs), block_words=block_words).collect():
        shards[r.source].append(r)
        targets[r.source] = r.target
    for source, rows in shards.items():
        rows.sort(key=lambda r: (r.first_word, r.size > 0))
        assert abs(sum(r.taken for r in rows) - targets[source]) <= 1
        assert [r.taken for r in rows] == plain_taken(rows, block_words)


def test_mix_of_small_sources(frame):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(n)), s) for i, (n, s) in enumerate([(65, "a"), (30, "b"), (10, "c"), (5000, "d"), (0, "e")])]
    got = plan_mix(sized(frame(rows, extra=False))).collect()
    assert all(abs(r.taken - r.target) <= 1 and r.taken <= 2 * r.size for r in got)
    assert {r.source: r.taken for r in got if r.source in "abc"} == {"a": 130, "b": 60, "c": 20}
    mixed = mix_sources(frame(rows))
    words = Counter({r.doc_id: 0 for r in got})
    for r in mixed.collect():
        words[r.doc_id] += len(brute.SPACE.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in got})


# 5


def seq(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


OID = seq(0x30, bytes.fromhex("06092a864886f70d010101") + b"\x05\x00")


def test_private_and_public_keys():
    version, number = b"\x02\x01\x00", seq(0x02, bytes(range(1, 100)))
    assert is_key(seq(0x30, version + number * 8))  # PKCS 1
    assert is_key(seq(0x30, version + OID + seq(0x04, bytes(90))))  # PKCS 8
    assert is_key(seq(0x30, b"\x02\x01\x01" + seq(0x04, bytes(32)) + seq(0xA0, b"\x06\x03\x2b\x65\x70")))  # SEC 1
    assert is_key(seq(0x30, OID + seq(0x04, bytes(90))))  # encrypted
    assert not is_key(seq(0x30, OID + seq(0x03, bytes(90))))  # a public key
    assert not is_key(seq(0x30, number + b"\x02\x03\x01\x00\x01"))  # PKCS 1, public
    certificate = seq(0x30, seq(0x30, seq(0xA0, b"\x02\x01\x02") + number + OID) + OID + seq(0x03, bytes(90)))
    assert not is_key(certificate) and not is_key(seq(0x30, number)) and not is_key(b"")
    for data in (certificate, seq(0x30, OID + seq(0x03, bytes(90)))):
        assert secret_spans(f"see {base64.b64encode(data).decode()} here", ["der", "pem"]) == []


def field(x):
    return len(x).to_bytes(4, "big") + x


def openssh(cipher=b"none", keys=1, private=b"abcdabcd" + bytes(60)):
    head = b"openssh-key-v1\0" + field(cipher) + field(b"none") + field(b"") + keys.to_bytes(4, "big")
    return head + field(field(b"ssh-ed25519") + field(bytes(32))) * keys + field(private)


def test_openssh_fields():
    key = openssh()
    assert is_openssh_key(key) and is_openssh_key(openssh(keys=3)) and is_openssh_key(openssh(b"aes256-ctr", private=bytes(range(64))))
    assert not is_openssh_key(openssh(private=bytes(range(64)))) and not is_openssh_key(openssh(keys=0))
    for bad in (key[:-1], key + b"\0", key[:15], b"openssh-key-v1\0" + bytes(100), b"x" + key):
        assert not is_openssh_key(bad)
    text = lambda data: f"-----BEGIN OPENSSH PRIVATE KEY-----\n{base64.b64encode(data).decode()}\n-----END OPENSSH PRIVATE KEY-----"
    assert len(secret_spans(text(key), ["pem"])) == 1 and secret_spans(text(key[:40]), ["pem"]) == []


def test_pem_edges():
    key = base64.b64encode(seq(0x30, b"\x02\x01\x00" + OID + seq(0x04, bytes(90)))).decode()
    whole = f"-----BEGIN PRIVATE KEY-----\n{key}\n-----END PRIVATE KEY-----"
    start = "-----BEGIN PRIVATE KEY-----\n"
    assert secret_spans(start + whole, ["pem"]) == [(len(start), 3, len(start) + len(whole))]  # the nearest BEGIN
    assert secret_spans(whole.replace("END", "END RSA"), ["pem"]) == []
    assert len(secret_spans(f"{whole}\n{whole} -----END PRIVATE KEY-----", ["pem"])) == 2
    began = time.process_time()
    assert secret_spans(start * 36_000, ["pem"]) == []  # 1 MB
    assert time.process_time() - began < 1


# 7


def test_texts_of_equal_short_hash_keep_their_own_words(spark):
    """Two texts without an id that agree in a 32-bit hash: what is removed from one stays in the other."""
    passage = " ".join(f"p{i}" for i in range(48))
    ids = spark.range(200_000, numPartitions=8)
    own = ids.selectExpr("array_join(transform(sequence(0, 60), j -> concat('x', id, 'w', j)), ' ') AS text")
    copied = ids.selectExpr(f"concat('{passage} y', id) AS other")
    pair = own.withColumn("h", F.hash("text")).join(copied.withColumn("h", F.hash("other")), "h").first()
    assert pair is not None
    docs = spark.createDataFrame([(1, passage), (None, pair["text"]), (None, pair["other"])], "doc_id long, text string")
    got = {r.text: (r.n_words, r.n_removed) for r in remove_repeats(docs).collect()}
    assert got == {passage: (48, 0), pair["text"]: (61, 0), pair["other"]: (49, 48)}
