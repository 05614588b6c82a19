"""Neural models as plug-ins: what each takes and gives, an adapter to tables, and stand-ins.

A model is a callable made once in each worker process.  Rows go in with the columns its contract
names; what it returns becomes rows of the contract's table.  An error stays with its row, in the
column ``error``, and does not stop the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .shipping import ship

#: For each model: the columns it reads and the columns of each row it returns.
CONTRACTS = {
    "detector": (("video_id", "frame", "image"), "x double, y double, w double, h double, score double, vector array<float>"),
    "diarizer": (("video_id", "audio"), "speaker string, start double, end double"),
    "speaking": (("video_id", "track_id", "crops", "audio"), "frame long, probability double"),
    "extractor": (("video_id", "name", "crops", "audio"), "samples array<float>, sample_rate int"),
    "transcriber": (("video_id", "name", "audio", "language"), "text string, language string, language_probability double, detected boolean, avg_logprob double, no_speech_prob double, compression_ratio double"),
    "tagger": (("video_id", "name", "audio"), "dimension string, label string, score double"),
    "captioner": (("video_id", "index", "frames", "prompt"), "caption string"),
}


_KEPT: dict[tuple[str, str], Callable] = {}


def kept(kind: str, key: str, make: Callable[[], Callable]) -> Callable:
    """The model of a kind and key in this worker, made where another one is held."""
    if (kind, key) not in _KEPT:
        _KEPT.clear()
        _KEPT[kind, key] = make()
    return _KEPT[kind, key]


def run_model(rows: DataFrame, kind: str, make: Callable[[], Callable[..., list[tuple]]], key: str | None = None) -> DataFrame:
    """Rows of ``kind``'s contract for each input row: its keys, the model's columns, ``error``.

    ``make()`` builds the model in the worker, once for all its tasks where ``key`` names it (the last
    one made is kept: a worker holds one model); else once for each task.  The model gets the contract's columns but the video's
    id and returns tuples.  Keys are the contract's columns of plain type.
    """
    takes, gives = CONTRACTS[kind]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [c.strip().split(" ")[0] for c in gives.split(", ")]
    keys = [c for c in takes if kinds[c] in ("string", "int", "bigint") and c not in names]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                own = [row[k] for k in keys]
                try:
                    model = model or (make() if key is None else kept(kind, key, make))
                    out += [(*own, *found, None) for found in model(**{k: v for k, v in row.items() if k != "video_id"})]
                except Exception as why:  # the row's own failure
                    out.append((*own, *[None] * len(names), f"{type(why).__name__}: {why}"))
            yield pd.DataFrame(out, columns=[*keys, *names, "error"])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"`{c.split(' ')[0]}` {c.split(' ', 1)[1]}" for c in gives.split(", ")), "error string"])
    ship(rows.sparkSession)
    return rows.select(*takes).mapInPandas(work, schema)


def two_faces(image=None, frame: int = 0) -> list[tuple]:
    """A detector for tests: two faces that drift to the right."""
    return [(100.0 + 0.2 * frame, 100.0, 40.0, 50.0, 0.9, [1.0, 0.0]), (400.0 + 0.2 * frame, 100.0, 40.0, 50.0, 0.9, [0.0, 1.0])]


def echo(name: str, audio=None, language: str | None = None) -> list[tuple]:
    """A transcriber for tests: says its segment's name."""
    return [(f" {name}", language or "en", 0.9, language is None, -0.2, 0.01, 1.0)]


def two_voices(audio=None) -> list[tuple]:
    """A diarizer for tests: two speakers, one after the other."""
    return [("spk_00", 0.0, 4.0), ("spk_01", 4.5, 9.0)]


def first_half(track_id: int, crops=None, audio=None) -> list[tuple]:
    """A model of who speaks for tests: track 1 speaks in the first hundred frames, others after them."""
    return [(f, 0.9 if (f < 110) == (track_id == 1) else 0.1) for f in range(0, 225, 3)]


def moods(name: str, audio=None) -> list[tuple]:
    """A tagger for tests: by the last digit of a segment's name."""
    return [("event", "Laughter", 0.9)] if int(name[-1]) < 5 else [("emotion", "sad", 0.8), ("event", "Speech", 0.95)]


def plain_caption(index: int, frames=None, prompt: str = "") -> list[tuple]:
    """A captioner for tests: names the first person, whether in view or not."""
    return [(f"Shot {index} shows F001.",)]
