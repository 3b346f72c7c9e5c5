"""threadsift: community-post and saved-page analytics as Spark DataFrame jobs.

Typical use::

    from threadsift.sources.readers import read_posts
    from threadsift.plans import pain_points as PP, demographics as DM, statistics as ST
    from threadsift import lexicons as L

    posts, quarantine = read_posts(spark, jsonl_path="s3://.../posts/", batched_path="s3://.../legacy/")
    tagged = PP.analyze(posts, L.pain_lexicon())
    ranking = PP.tag_ranking(PP.tag_stats(tagged, L.pain_lexicon()))
    profiles = DM.profiles(DM.label_posts(posts)).persist()
    sections = ST.report_sections(profiles)   # dict name -> DataFrame, see sources.sinks.write_report

Lexicons are plain data (``lexicons.Lexicon``); pass your own to any tagger or
classifier.  Streaming ingest lives in ``threadsift.streaming.ingest``.
"""

__all__ = ["functions", "lexicons", "operators", "plans", "schema", "session", "sources", "streaming"]
