"""A file that breaks off must not lose posts unseen."""

import gzip
import json
import os
import random

import pytest

from threadsift.sources import readers as RD


def broken(folder, text):
    with open(os.path.join(folder, "a.json.gz"), "wb") as f:
        f.write(gzip.compress(text.encode())[:-2000])


def test_read_errors_are_seen(spark, tmp_path):
    r = random.Random(1)
    posts = [{"text": f"{r.random()} {i}"} for i in range(3000)]
    for name, text in (("lines", "\n".join(map(json.dumps, posts))), ("batched", "\n".join(json.dumps({"posts": [p]}) for p in posts))):
        path = tmp_path / name
        path.mkdir()
        broken(path, text)
        how = {"jsonl_path": str(path)} if name == "lines" else {"batched_path": str(path), "lines": True}
        with pytest.raises(Exception, match="(?i)unexpected end|eof|corrupt|FAILED_READ_FILE"):
            RD.read_posts(spark, **how)[0].collect()
        kept = RD.read_posts(spark, **how, skip_unreadable=True)[0].count()
        assert kept < len(posts)
