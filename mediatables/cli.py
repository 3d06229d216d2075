"""Command line: ``python -m mediatables <command> ...``.

Every command builds (or reuses) a SparkSession and calls the job function of
the same name. Models are named as ``module:factory`` and imported on the
driver; the factory is shipped to the workers. Query commands print at most
``--top-k`` rows (``take``), one dict per line.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Sequence

from .schemas import AudioConfig, ImageConfig


def _factory(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _range(args) -> tuple[float, float] | None:
    if args.distance_min is None and args.distance_max is None:
        return None
    if args.distance_min is None or args.distance_max is None:
        raise SystemExit("--distance-min and --distance-max must be provided together")
    return args.distance_min, args.distance_max


def _print(df, top_k: int) -> None:
    for row in df.take(top_k):
        print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))


# Options that set thresholds of the job configurations.
AUDIO_THRESHOLDS = ("min_duration_s", "max_duration_s")
IMAGE_THRESHOLDS = ("face_score_min", "min_face_ratio", "blur_threshold", "face_blur_threshold")


def _add_thresholds(parser: argparse.ArgumentParser, config, names: Sequence[str]) -> None:
    for name in names:
        parser.add_argument(f"--{name.replace('_', '-')}", type=float, default=getattr(config, name))


def _config(args, kind, names: Sequence[str]):
    return kind(**{name: getattr(args, name) for name in names})


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mediatables")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="command", required=True)

    m = sub.add_parser("manifest", help="list media files into a Parquet manifest (C9)")
    m.add_argument("--dir", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--media", choices=["audio", "image"], default="image")

    aa = sub.add_parser("analyze-audio", help="C1: manifest -> duration gate -> ASR -> redaction -> tags [-> embedding]")
    aa.add_argument("--manifest", required=True)
    aa.add_argument("--out", required=True)
    aa.add_argument("--embed", action="store_true")
    aa.add_argument("--root", action="append", default=[], help="media prefix (repeatable)")
    aa.add_argument("--asr-factory", required=True)
    aa.add_argument("--llm-factory")
    _add_thresholds(aa, AudioConfig(), AUDIO_THRESHOLDS)

    ia = sub.add_parser("ingest-audio", help="C2: analysis + audio bytes -> append to the asset table")
    ia.add_argument("--analysis", required=True)
    ia.add_argument("--table", required=True)
    ia.add_argument("--root", action="append", default=[])

    qa = sub.add_parser("query-audio", help="C3: sql > vector-from > where")
    qa.add_argument("--table", required=True)
    qa.add_argument("--where")
    qa.add_argument("--sql")
    qa.add_argument("--top-k", type=int, default=10)
    qa.add_argument("--vector-from", dest="query_doc_id")
    qa.add_argument("--distance-min", type=float)
    qa.add_argument("--distance-max", type=float)

    ai = sub.add_parser("analyze-images", help="C4: manifest -> status, measures, verdicts [-> embedding]")
    ai.add_argument("--manifest", required=True)
    ai.add_argument("--out", required=True)
    ai.add_argument("--root", action="append", required=True)
    ai.add_argument("--embed", action="store_true")
    ai.add_argument("--quality-factory")
    ai.add_argument("--embedder-factory")
    _add_thresholds(ai, ImageConfig(), IMAGE_THRESHOLDS)

    ii = sub.add_parser("ingest-images", help="C5: analysis + image bytes -> append to the asset table")
    ii.add_argument("--analysis", required=True)
    ii.add_argument("--table", required=True)
    ii.add_argument("--root", action="append", default=[])

    qi = sub.add_parser("query-images", help="C6: sql > text > image-path > image-from > where")
    qi.add_argument("--table", required=True)
    qi.add_argument("--where")
    qi.add_argument("--sql")
    qi.add_argument("--top-k", type=int, default=10)
    qi.add_argument("--text")
    qi.add_argument("--image-path")
    qi.add_argument("--image-from")
    qi.add_argument("--desc-table")
    qi.add_argument("--embedder-factory")
    qi.add_argument("--distance-min", type=float)
    qi.add_argument("--distance-max", type=float)

    ix = sub.add_parser("index", help="C7: IVF vector index and/or ingest_time zone map")
    ix.add_argument("--table", required=True)
    ix.add_argument("--no-embedding", dest="embedding", action="store_false")
    ix.add_argument("--no-time", dest="time", action="store_false")
    ix.add_argument("--embedding-column", default="audio_embedding")
    ix.add_argument("--num-partitions", type=int, default=16)
    ix.add_argument("--num-sub-vectors", type=int, default=16)
    ix.add_argument("--sample-rate", type=int, default=256)
    ix.add_argument("--index-type", default="IVF_PQ",
                    choices=["IVF_PQ", "IVF_FLAT", "IVF_SQ", "IVF_HNSW_PQ", "IVF_HNSW_FLAT"])

    mg = sub.add_parser("manage", help="C8: delete rows with before/after bounds")
    mg.add_argument("--table", required=True)
    mg.add_argument("--before")
    mg.add_argument("--after")
    return p


def main(argv: Sequence[str] | None = None, spark=None) -> int:
    from .plans import jobs, query
    from .session import build_session, configure

    args = build_parser().parse_args(argv)
    if spark is None:
        spark = build_session(args.master)
    configure(spark)
    roots = getattr(args, "root", None) or None
    cmd = args.command
    if cmd == "manifest":
        print(f"[ok] {jobs.init_manifest(spark, args.dir, args.out, args.media)} files -> {args.out}")
    elif cmd == "analyze-audio":
        jobs.analyze_audio(spark, args.manifest, args.out, embed=args.embed, roots=roots,
                           asr_factory=_factory(args.asr_factory), llm_factory=_factory(args.llm_factory),
                           cfg=_config(args, AudioConfig, AUDIO_THRESHOLDS))
        print(f"[ok] wrote {args.out}")
    elif cmd == "ingest-audio":
        print(f"[ok] total rows: {jobs.ingest_audio(spark, args.analysis, args.table, roots=roots)}")
    elif cmd == "query-audio":
        _print(query.query_audio(spark, args.table, args.where, args.sql, args.top_k,
                                 args.query_doc_id, _range(args)), args.top_k)
    elif cmd == "analyze-images":
        kwargs = {"cfg": _config(args, ImageConfig, IMAGE_THRESHOLDS)}
        if args.quality_factory:
            kwargs["quality_factory"] = _factory(args.quality_factory)
        if args.embedder_factory:
            kwargs["embedder_factory"] = _factory(args.embedder_factory)
        jobs.analyze_images(spark, args.manifest, args.out, args.root, embed=args.embed, **kwargs)
        print(f"[ok] wrote {args.out}")
    elif cmd == "ingest-images":
        print(f"[ok] total rows: {jobs.ingest_images(spark, args.analysis, args.table, roots=roots)}")
    elif cmd == "query-images":
        image = None
        if args.image_path:
            with open(args.image_path, "rb") as fp:
                image = fp.read()
        embedder = _factory(args.embedder_factory)
        _print(query.query_images(spark, args.table, args.where, args.sql, args.top_k, args.text, image,
                                  args.image_from, _range(args), args.desc_table,
                                  embedder() if embedder else None), args.top_k)
    elif cmd == "index":
        out = jobs.build_indexes(spark, args.table, args.embedding, args.time, args.embedding_column,
                                 args.num_partitions, args.num_sub_vectors, args.sample_rate, args.index_type)
        print(f"[ok] built {sorted(out)} for {args.table}")
    elif cmd == "manage":
        report = jobs.manage(spark, args.table, args.before, args.after)
        print(f"[ok] dropped {report.dropped}, rewrote {report.rewritten}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
