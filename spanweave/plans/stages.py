"""The stages of an annotation run as transforms of tables, and what runs them in order.

Every table has ``video_id``.  A stage reads tables that earlier stages wrote and writes its own.  Its
models are plug-ins of ``spanweave.models``: ``config["models"][kind]`` makes one in each worker; what
a model gave before may be handed in as a table instead (``model_<kind>``) and is not asked for again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..models import run_model
from ..operators import captions as P
from ..operators import compose as C
from ..operators import document as D
from ..operators import intervals as I
from ..operators import qa as Q
from ..operators import script as G
from ..operators import solvers as L
from ..operators import speech as S
from ..operators import tags as T
from ..operators import transcripts as R
from ..sources import media as M
from ..sources import sound
from ..sources.published import digest
from ..storage import cut, unsent
from .lineage import STAGES, latest, reasons_to_run

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """A stage: what it reads and writes, and whether a graphics card speeds it up."""

    name: str
    version: str
    uses_gpu: bool
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    run: Callable[[Tables, Mapping], Tables]
    #: Tables that it uses where they are given.
    may_read: tuple[str, ...] = ()

    def inputs(self, tables: Mapping) -> tuple[str, ...]:
        return (*self.reads, *(t for t in self.may_read if t in tables))


def _no_flags() -> Column:
    return F.array().cast("array<string>")


def _asked(tables: Tables, config: Mapping, kind: str, rows: DataFrame) -> DataFrame:
    """What the model of a kind says of rows: from its table if there is one, else from the model."""
    if f"model_{kind}" in tables:
        return tables[f"model_{kind}"]
    made = (config.get("models") or {}).get(kind)
    if made is None:
        raise ValueError(f"no model for {kind}, and no table model_{kind}")
    return run_model(rows, kind, made)


SOUND_RATE = 16_000
SILENT = 1e-4


def _heard(tables: Tables, rows: DataFrame, config: Mapping) -> DataFrame:
    """Rows (``video_id, start, end``) with ``audio`` (a WAV file in memory), ``rms`` and ``error``.

    ``sound`` names each video's file and the time it begins at (``path, origin``); of it only the bytes of
    the rows' spans are read.  Without that table, or of a video that is not in it, there is no audio.
    """
    if "sound" not in tables:
        return rows.withColumns({"audio": F.lit(None).cast("binary"), "rms": F.lit(None).cast("double"), "error": F.lit(None).cast("string")})
    of = tables["sound"].select("video_id", F.col("path").alias("__path"), F.col("origin").alias("__origin"))
    spans = rows.join(of, "video_id").select("*", F.struct("__path", "__origin").alias("__of"))
    asked = spans.select(*rows.columns, F.col("__path").alias("path"), (F.col("start") - F.col("__origin")).alias("start_"), (F.col("end") - F.col("start")).alias("seconds"))
    asked = asked.withColumnsRenamed({"start": "__start", "start_": "start"})
    read = sound.spans(asked, int(config.get("sample_rate", SOUND_RATE)), wav=True)
    read = read.drop("path", "start", "seconds").withColumnRenamed("__start", "start")
    silent = I.apart(rows.join(of.select("video_id"), "video_id", "left_anti"))
    return unsent(cut(I.apart(read).unionByName(silent, allowMissingColumns=True)))


def _unheard(heard: DataFrame) -> DataFrame:
    return heard.where("error is not null").groupBy("video_id").agg(F.min("error").alias("error"))


def preprocess(tables: Tables, config: Mapping) -> Tables:
    """Timelines and shots from probes and scene logs; a video without sound fails."""
    found = M.probes(tables["answers"]).join(tables["sources"].select("video_id", "path"), "video_id")
    why = F.coalesce("problem", F.when(~F.col("has_audio"), "ValueError: the video has no audio stream"))
    good = found.where(why.isNull()).drop("problem")
    spans = good.select("video_id", F.lit(0.0).alias("start"), F.col("duration").alias("end"))
    return {"videos": good, "shots": I.tile(M.cuts(tables["logs"]).join(good.select("video_id"), "video_id", "left_semi"), spans), "failed": found.select("video_id", why.alias("error")).where("error is not null")}


def faces(tables: Tables, config: Mapping) -> Tables:
    """Detections and vectors of every sampled frame."""
    stride = int(config.get("stride", 3))
    sampled = M.sampled_frames(tables["videos"], stride)
    images = tables.get("frames")
    rows = sampled.withColumn("image", F.lit(None).cast("binary")) if images is None else sampled.join(images, ["video_id", "frame"])
    said = _asked(tables, config, "detector", rows)
    seen = said.where("error is null").join(tables["videos"].select("video_id", "fps"), "video_id").withColumns({"time": F.col("frame") / F.col("fps"), "emb": F.xxhash64("video_id", "frame", "x", "y", "w", "h")})
    return {"sampled": sampled, "detections": seen.select("video_id", "frame", "time", "x", "y", "w", "h", "score", "emb"), "embeddings": seen.where("vector is not null").select("video_id", "emb", F.col("vector").alias("vec")), "failed": said.where("error is not null").groupBy("video_id").agg(F.min("error").alias("error"))}


def tracks(tables: Tables, config: Mapping) -> Tables:
    """Detections joined to tracklets, and what each tracklet is worth."""
    found = L.track(tables["detections"], frames=tables["sampled"], **(config.get("tracker") or {}))
    both = found.join(tables["detections"].select("video_id", "frame", "x", "y", "w", "h", "score", "time", "emb"), ["video_id", "frame", "x", "y", "w", "h", "score"]).dropDuplicates(["video_id", "frame", "track_id"])
    order = ["video_id", "track_id"]
    quality = L.track_quality(both, 1.0).drop("span")
    span = both.groupBy(*order).agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("*").alias("detections"))
    return {"tracked": both, "tracks": quality.join(span, order).withColumn("span", F.col("last_time") - F.col("first_time"))}


def cluster(tables: Tables, config: Mapping) -> Tables:
    """Tracklets grouped to people; those too poor are dropped with their reason."""
    judged = L.rejection(tables["tracks"])
    vectors = C.track_vectors(tables["tracked"], tables["embeddings"])
    kept = judged.where("reason is null").join(vectors, ["video_id", "track_id"])
    groups = L.cluster(kept.withColumnRenamed("centroid", "vector"), most=float(config.get("max_distance", 0.45)))
    people = L.identities(groups, kept.select("video_id", "track_id", F.col("first_time").alias("first_seen"), F.col("last_time").alias("last_seen"), "span")).withColumnRenamed("face_id", "face")
    return {"identities": people, "dropped": judged.where("reason is not null").select("video_id", "track_id", "reason"), "vectors": vectors}


def diarize(tables: Tables, config: Mapping) -> Tables:
    """Speaker turns, clamped to the video, merged and without slivers."""
    audio = tables.get("audio")
    rows = tables["videos"].select("video_id").withColumn("audio", F.lit(None).cast("binary")) if audio is None else tables["videos"].select("video_id").join(audio, "video_id")
    said = _asked(tables, config, "diarizer", rows)
    timed = said.where("error is null" if "error" in said.columns else "true").join(tables["videos"].select("video_id", "duration"), "video_id")
    return {"turns": S.clean_turns(timed, F.col("duration"))}


def speaking(tables: Tables, config: Mapping) -> Tables:
    """How likely each tracklet speaks at each frame: the mean over the windows that hold it."""
    spans = tables["tracks"].select("video_id", "track_id", F.col("first_time").alias("start"), F.col("last_time").alias("end"))
    heard = _heard(tables, spans, config)
    crops = tables.get("crops")
    rows = heard.where("error is null").select("video_id", "track_id", "audio")
    rows = rows.withColumn("crops", F.lit(None).cast("binary")) if crops is None else rows.join(crops.select("video_id", "track_id", "crops"), ["video_id", "track_id"], "left")
    said = _asked(tables, config, "speaking", rows)
    per = said.where("error is null" if "error" in said.columns else "true").groupBy("video_id", "track_id", "frame").agg(F.avg("probability").alias("p"))
    return {"samples": per.join(tables["videos"].select("video_id", "fps"), "video_id").select("video_id", "track_id", (F.col("frame") / F.col("fps")).alias("t"), "p"), "failed": _unheard(heard)}


def associate(tables: Tables, config: Mapping) -> Tables:
    """Voices matched to people, and when each person speaks."""
    gap = float(config.get("presence_gap_seconds", 0.5))
    people = C.members(tables["identities"], tables["tracked"].select("video_id", "track_id", F.col("time").alias("t")))
    visible = C.visible_spans(people, gap=gap)
    samples = C.members(tables["identities"], tables["samples"]).select("video_id", "face", "t", "p")
    scores = L.speaker_scores(visible, samples, tables["turns"])
    found = unsent(cut(L.assign_speakers(scores, tables["turns"])))  # read for speech and by itself
    return {"visible": visible, "assignments": found, "speech": S.speaking(found, tables["turns"], gap=gap)}


def extract(tables: Tables, config: Mapping) -> Tables:
    """Segments of each person's speech, named, and where their sound is read from.

    ``voiced`` (video_id, start, end), where given, bounds them by voice activity.
    """
    timed = tables["speech"].join(tables["videos"].select("video_id", "duration"), "video_id")
    limits = tables["videos"].select("video_id", "duration")
    found = S.segments(timed.select("video_id", "duration", "face", "start", "end"), F.col("duration"), ["video_id", "duration", "face"], voiced=tables.get("voiced"))
    named = S.named(found, ["video_id"], "face").withColumns({"identity": F.col("face"), "flags": F.when(F.col("short"), F.array(F.lit("short"))).otherwise(_no_flags())})
    routed = S.route_sources(named.select("video_id", "identity", "start", "end").join(limits, "video_id"), F.col("duration"), ["video_id", "duration"], "identity")
    both = unsent(named).join(routed.select("video_id", "identity", "start", "end", "source", "origin", "until"), ["video_id", "identity", "start", "end"])
    return {"segments": both.select("video_id", "identity", "index", "name", "start", "end", (F.col("end") - F.col("start")).alias("duration"), "flags", "source", "origin", "until")}


def transcribe(tables: Tables, config: Mapping) -> Tables:
    """What each segment says: long ones with their language detected, short ones in the video's.

    What the model said is written, so that each segment is asked once whatever is read of it.
    """
    heard = _heard(tables, tables["segments"], config)
    rows = heard.where("error is null").drop("error")
    long = rows.where("duration >= 3").withColumn("language", F.lit(None).cast("string"))
    ask = lambda some: _asked(tables, config, "transcriber", some.select("video_id", "name", "audio", "language"))
    first = unsent(cut(ask(long).join(long.select("video_id", "name"), ["video_id", "name"], "left_semi")))
    heard = long.select("video_id", "name", "duration").join(first, ["video_id", "name"]).withColumn("probability", F.col("language_probability"))
    sample = S.take_until(rows.select("video_id", "name", "start", "duration")).join(first, ["video_id", "name"]).groupBy("video_id").agg(F.max_by("language", "duration").alias("code"), F.max_by("language_probability", "duration").alias("confidence"))
    decided = unsent(cut(S.language_of(I.apart(heard).unionByName(rows.select("video_id", "name", "duration"), allowMissingColumns=True).na.fill(False, ["detected"]), sample)))
    short = S.forced_language(rows.where("duration < 3"), decided)
    second = unsent(cut(ask(short).join(short.select("video_id", "name"), ["video_id", "name"], "left_semi")))
    said = I.apart(first).unionByName(I.apart(second)).join(decided.select("video_id", "code"), "video_id", "left")
    clashes = F.coalesce(F.col("detected") & (F.col("language") != F.col("code")) & (F.col("language") != ""), F.lit(False))
    said = said.join(rows.select("video_id", "name", (F.coalesce(F.col("rms") < SILENT, F.lit(False)) & (F.col("source") == "extraction")).alias("silent")), ["video_id", "name"], "left")
    flags = R.flags(F.col("text"), F.col("no_speech_prob"), F.col("avg_logprob"), F.col("compression_ratio"))
    flags = F.array_compact(F.concat(flags, F.array(F.when(clashes, "language_mismatch"), F.when(F.col("silent"), "silent_extraction"))))
    return {"transcripts": said.withColumn("flags", flags).drop("code", "silent"), "language": decided, "failed": _unheard(heard)}


def tag(tables: Tables, config: Mapping) -> Tables:
    """One tag for each segment that is long enough."""
    fit = tables["segments"].where(F.col("duration") >= float(config.get("least_seconds", 0.5)))
    rows = _heard(tables, fit.select("video_id", "name", "start", "end"), config).where("error is null").select("video_id", "name", "audio")
    scores = _asked(tables, config, "tagger", rows).where("score is not null")
    words = F.broadcast(T.vocabulary(scores.sparkSession))  # a fixed table
    return {"tags": T.reduce_tags(scores, words, ["video_id", "name"], config.get("min_score", 0.5), every=fit.select("video_id", "name"))}


def caption(tables: Tables, config: Mapping) -> Tables:
    """Captions of shots, cleared of people who are not in view, and the global one."""
    listed = P.rosters(tables["visible"], tables["shots"])
    known = tables["identities"].groupBy("video_id").agg(F.array_sort(F.collect_set("face")).alias("known"))
    prompts = listed.withColumn("prompt", P.shot_prompt(F.col("index"), F.col("start"), F.col("end"), F.col("roster")))
    images = tables.get("shot_frames")
    prompts = prompts.withColumn("frames", F.lit(None).cast("binary")) if images is None else prompts.join(images.select("video_id", "index", "frames"), ["video_id", "index"], "left")
    said = _asked(tables, config, "captioner", prompts.select("video_id", "index", "frames", "prompt"))
    both = listed.join(said.select("video_id", "index", F.col("caption").alias("text")), ["video_id", "index"], "left").join(known, "video_id", "left")
    checked = P.checked_caption(both.withColumns({"text": F.coalesce("text", F.lit("")), "known": F.coalesce("known", _no_flags())}))
    whole = tables["videos"].select("video_id").withColumn("index", F.lit(0)).join(said.select("video_id", "index", F.col("caption").alias("text")), ["video_id", "index"], "left").join(C.shot_identities(listed), "video_id", "left").join(known, "video_id", "left")
    overall = P.checked_caption(whole.select("video_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("identities", _no_flags()).alias("roster"), F.coalesce("known", _no_flags()).alias("known")))
    return {"captions": checked.select("video_id", "index", "caption", "referenced", "dropped", "flags"), "overall": overall.select("video_id", "caption", "dropped", "flags")}


def compose(tables: Tables, config: Mapping) -> Tables:
    """The deliverable of each video: document, script, checks and numbers."""
    videos = tables["videos"].join(tables["overall"].select("video_id", "caption"), "video_id", "left")
    segs = tables["segments"].join(videos.select("video_id", F.col("duration").alias("__limit")), "video_id")
    texts = tables["transcripts"].select("video_id", "name", "text", "language_probability", "avg_logprob", "flags")
    said = R.utterances(segs.withColumnRenamed("flags", "segment_flags"), texts, tables["tags"].select("video_id", "name", "tag"), F.col("__limit"))
    said = said.withColumns({"audio": F.concat(F.lit("segments/"), "name", F.lit(".wav")), "words": F.lit(None).cast("array<struct<text:string,start:double,end:double>>")})
    shots = C.shots_with_captions(tables["shots"], tables["captions"])
    seen = C.face_tracks(C.members(tables["identities"], tables["tracks"]), tables["speech"])
    language = tables["language"].select("video_id", F.struct("code", "confidence", "source").alias("language"))
    scripts = G.render(videos.select("video_id", "caption"), shots, said)
    voiced = S.voiced_seconds(tables["turns"], videos)
    checked = Q.gates(said, seen, videos.select("video_id", "duration").join(voiced, "video_id"), tolerance=float(config.get("accounting_tolerance", 1.5)), scripts=scripts)
    return {
        "utterances": said,
        "face_tracks": seen,
        "documents": D.documents(videos.join(language, "video_id", "left"), shots, said, seen),
        "scripts": scripts,
        "gates": checked,
        "metrics": Q.metrics(said, seen, videos),
    }


REGISTRY = {
    s.name: s
    for s in (
        Stage(STAGES[0], "s0-v2", False, ("sources", "answers", "logs"), ("videos", "shots"), preprocess),
        Stage(STAGES[1], "s1-v1", True, ("videos",), ("sampled", "detections", "embeddings"), faces, ("frames",)),
        Stage(STAGES[2], "s2-v1", False, ("detections", "sampled"), ("tracked", "tracks"), tracks),
        Stage(STAGES[3], "s3-v2", False, ("tracks", "tracked", "embeddings"), ("identities", "dropped", "vectors"), cluster),
        Stage(STAGES[4], "s4-v1", True, ("videos",), ("turns",), diarize, ("audio",)),
        Stage(STAGES[5], "s5-v2", True, ("tracks", "videos"), ("samples",), speaking, ("sound", "crops")),
        Stage(STAGES[6], "s6-v1", False, ("identities", "tracked", "samples", "turns"), ("visible", "assignments", "speech"), associate),
        Stage(STAGES[7], "s7-v1", True, ("speech", "videos"), ("segments",), extract, ("voiced",)),
        Stage(STAGES[8], "s8-v1", True, ("segments",), ("transcripts", "language"), transcribe, ("sound",)),
        Stage(STAGES[9], "s9-v1", True, ("segments",), ("tags",), tag, ("sound",)),
        Stage(STAGES[10], "s10-v1", True, ("videos", "shots", "visible", "identities"), ("captions", "overall"), caption, ("shot_frames",)),
        Stage(STAGES[11], "s11-v4", False, ("videos", "shots", "captions", "overall", "identities", "tracks", "speech", "turns", "segments", "transcripts", "language", "tags"), ("utterances", "face_tracks", "documents", "scripts", "gates", "metrics"), compose),
    )
}


def available() -> tuple[str, ...]:
    return tuple(s for s in STAGES if s in REGISTRY)


def uses_gpu(name: str) -> bool:
    """Whether a stage's work is done on a card; of a stage that is not known, yes."""
    return name not in REGISTRY or REGISTRY[name].uses_gpu


def get_stage(name: str) -> Stage:
    if name not in REGISTRY:
        raise KeyError(f"unknown stage {name!r}; known stages: {', '.join(STAGES)}")
    return REGISTRY[name]


def needed(stage: Stage, tables: Tables) -> None:
    """Fails with the stage to run first where a table is not there."""
    for name in stage.reads:
        if name not in tables:
            by = next((s.name for s in REGISTRY.values() if name in s.writes), None)
            raise FileNotFoundError(f"{stage.name} has no table {name}; " + (f"run {by} first" if by else "give it as an input"))


def input_hashes(stage: Stage, tables: Tables, config: Mapping, digests: Tables | None = None) -> DataFrame:
    """``video_id, input_hash``: of the stage's settings and of what each table it reads has of the video.

    Rows count whatever their order; each table is summed up by video before its sums meet.  ``digests``
    (``published.digest`` of a table) spare reading the tables they are of.
    """
    said = json.dumps({k: v for k, v in sorted(config.items()) if k != "models"}, sort_keys=True)
    parts = []
    for name in stage.inputs(tables):
        df = (digests or {}).get(name)
        df = digest(tables[name]) if df is None else df
        parts.append(df.select("video_id", F.concat_ws(":", F.lit(name), "h", "n").alias("part")))
    if "videos" in tables and "videos" not in stage.writes:  # a video without any rows to read is still one to run
        every = (digests or {}).get("videos")
        parts.append((tables["videos"] if every is None else every).select("video_id", F.lit("").alias("part")))
    every = reduce(DataFrame.unionByName, map(I.apart, parts))
    return every.groupBy("video_id").agg(F.sha2(F.concat_ws("|", F.lit(said), F.array_join(F.array_sort(F.collect_list("part")), "|")), 256).alias("input_hash"))


#: Videos to run up to which they are looked for by name, so that scans skip all others.
FEW = 1000


def run_stages(
    tables: Tables,
    names: Sequence[str],
    config: Mapping[str, Mapping] | None = None,
    state: DataFrame | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
    digests: Tables | None = None,
    changes: dict[str, tuple[DataFrame, DataFrame]] | None = None,
    narrow: Callable[[str, list], DataFrame | None] = lambda name, videos: None,
) -> tuple[Tables, DataFrame]:
    """Run stages in order; returns all tables and the state records of this run.

    ``tables`` may hold what an earlier run wrote: with ``state`` (its records) a stage then runs for
    those videos alone that have a reason to run, and the others keep their rows.  ``store`` writes a
    table that a later stage reads and reads it back, which keeps plans short; stages get tables marked as
    ``unsent``, as all grow with the videos; records have video_id, stage, status, error,
    code_version, input_hash and reason.  Videos that fail at a stage are left out after it.  ``digests`` of
    tables spare reading them to see what changed; ``changes`` is given each table's new rows and the
    videos they are of; ``narrow`` may give a table's rows of few videos by a shorter way than a filter.
    """
    origin, tables, config, records = tables, dict(tables), config or {}, None
    digests, fresh = dict(digests or {}), {}

    def of(name: str, due: DataFrame, some: list) -> DataFrame:
        """A table's rows of the videos to run."""
        few = lambda df: df.where(F.col("video_id").isin(some)) if len(some) <= FEW else df.join(due, "video_id", "left_semi")
        if name not in origin:
            return few(tables[name])
        before = narrow(name, some) if len(some) <= FEW else None
        before = few(origin[name]) if before is None else before
        if name not in fresh:
            return before
        df, made_for = fresh[name]
        return I.apart(few(df)).unionByName(I.apart(before.join(made_for, "video_id", "left_anti").select(*df.columns)))

    for i, name in enumerate(names):
        stage = get_stage(name)
        read_later = {t for later in names[i + 1 :] for t in get_stage(later).inputs(tables)}
        own = config.get(name) or {}
        needed(stage, tables)
        planned = input_hashes(stage, tables, own, digests).select("video_id", F.lit(name).alias("stage"), F.lit(stage.version).alias("code_version"), "input_hash")
        reason = F.lit("no previous run")
        if state is not None:
            known = reasons_to_run(planned, state).withColumnRenamed("reason", "__r")
            planned = planned.join(known, ["video_id", "stage"], "left")
            reason = F.col("__r")
        planned = planned.withColumn("reason", reason).select("video_id", "stage", "code_version", "input_hash", "reason")
        planned = planned if state is None else store(planned)
        due = planned.where("reason is not null").select("video_id")
        given = tables
        if state is not None:
            some = [r["video_id"] for r in due.limit(FEW + 1).collect()]
            given = {k: of(k, due, some) if k in stage.inputs(tables) or k.startswith("model_") else v for k, v in tables.items()}
        made = stage.run({k: unsent(v) for k, v in given.items()}, own)
        failed = made.pop("failed", None)
        for table, df in made.items():
            before = tables.get(table)
            if changes is not None:
                df = store(df)
                changes[table] = df, due
            if state is None or before is None:
                tables[table] = store(df) if table in read_later and changes is None else df
                digests.pop(table, None)
                continue
            fresh[table] = df, due
            both = I.apart(df).unionByName(I.apart(before.join(due, "video_id", "left_anti").select(*df.columns)))
            tables[table] = store(both) if table in read_later and changes is None else both
            if table in digests:
                new = digest(df)
                digests[table] = I.apart(new).unionByName(I.apart(digests[table].select(*new.columns).join(due, "video_id", "left_anti")))
        said = planned.where("reason is not null")
        if failed is not None:
            said = said.join(failed, "video_id", "left")
        status = F.when(F.col("error").isNull(), "ok").otherwise("failed") if failed is not None else F.lit("ok")
        row = said.select("video_id", "stage", status.alias("status"), (F.col("error") if failed is not None else F.lit(None).cast("string")).alias("error"), "code_version", "input_hash", "reason")
        records = row if records is None else I.apart(records).unionByName(I.apart(row))
    return tables, records


def upsert(state: DataFrame, records: DataFrame) -> DataFrame:
    """State with new records (``finished_at`` greater) in the place of older ones of their video and stage."""
    return latest(state.unionByName(records, allowMissingColumns=True))
