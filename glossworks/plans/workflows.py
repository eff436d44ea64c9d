"""The three workloads end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossworks.functions.common import materialize
from glossworks.functions.text import content_words, expand_contractions, pack_clauses, split_sentences
from glossworks.operators import augment, batches, gloss, review, segments, training, variants, vocab


def text_to_batch(texts: DataFrame, words: DataFrame, lemmas: DataFrame, pos_lexicon: DataFrame, batch_id: str) -> dict[str, DataFrame]:
    """Texts (id, text) -> clauses without contractions -> words and phrases -> glosses -> vocabulary and recording batch.

    Distinct tokens only meet the vocabulary; a repeated clause is one row of
    the glosses, while the vocabulary counts every occurrence.
    """
    clauses = pack_clauses(split_sentences(texts.select("id", "text"), ["id"]), ["id", "pos"]).withColumnRenamed("pos", "sentence_pos")
    keep = ["id", "sentence_pos", "clause_pos", "clause"]
    phrases = words.select(F.lower("word").alias("phrase")).where("phrase LIKE '% %'")
    # written once: phrases are joined to places, and both the lookup and the glosses read them
    tokens = materialize(content_words(gloss.tokenize_with_phrases(clauses.withColumn("expanded", expand_contractions(F.col("clause"))), keep, phrases, "expanded")), "tokens")
    found = gloss.lookup_vocab(tokens, words, lemmas)
    of_clause = materialize(gloss.extract_glosses(tokens, keep, found, pos_lexicon), "glosses")
    rows = of_clause.select(F.col("clause").alias("sentence"), F.posexplode("glosses").alias("p", "gloss"), F.struct("id", "sentence_pos", "clause_pos").alias("c"))
    rows = rows.select("sentence", "gloss", F.struct("c.id", "c.sentence_pos", "c.clause_pos", "p").alias("seq"))
    sentences = clauses.select(F.col("clause").alias("text"), F.struct("id", "sentence_pos", "clause_pos", F.lit(-1).alias("p")).alias("seq"))
    return {"glosses": of_clause, "vocabulary": gloss.vocab_stats(of_clause), "batch": batches.build_batch(rows, sentences, batch_id)}


def reviews_to_training_set(subs: DataFrame, decs: DataFrame, accepted: DataFrame, texts: DataFrame, glosses: DataFrame, sources: DataFrame, index: DataFrame, frames: DataFrame, target: int | None = None, times: float | None = None, preset: str = "36x", seed: int = 0, want: tuple[str, ...] = ("entries", "recipe", "variants")) -> dict[str, DataFrame]:
    """Review logs -> manifest -> padded entries -> resources -> variants -> split. Everything is planned on ids.

    Of entries, recipe and variants what is wanted is made, each from the steps that it is made of: entries need no variants, and
    variants, which pads have none of, no pads.
    glosses: sentence, glosses; sources: as of pad_to_target; index: token, name, seq; frames: name, n_frames.
    """
    manifest = review.collect(subs, decs, accepted, texts)
    manifest = materialize(manifest, "manifest")
    made = {"manifest": manifest}
    pads = training.pad_to_target(manifest, sources, target or training.TARGET, times) if "entries" in want else None
    entries = materialize(training.build_entries(manifest, pads, glosses), "entries")
    if "entries" in want:
        made["entries"] = training.split_train_val_test(entries, seed=42)
    if not {"recipe", "variants"} & set(want):
        return made
    own = entries.where("NOT is_pad")
    resolved = training.resolve_resources(training.entry_tokens(own), index, frames)
    usable = resolved.where("has_feature").select("token", "ord", "name").withColumn("category", F.explode(F.array(F.lit("B"), F.lit("C"))))
    plans = variants.clip_plans(own, usable, frames, preset, seed)
    if "recipe" in want:
        plans = materialize(plans, "plans") if "variants" in want else plans  # for two readers: orders and clips are drawn once
        made["recipe"] = variants.plan_rows(plans)
    if "variants" in want:
        base = variants.expand_variants(own, preset, seed, "A")
        kept = materialize(base.select("variant_id", "category").unionByName(variants.plan_variants(plans).select("variant_id", "category")), "kept")
        made["variants"] = training.split_variants(kept)
    return made


def segments_to_labels(raw: DataFrame, videos: DataFrame, augs: DataFrame, existing: DataFrame, params: DataFrame, gloss_map: DataFrame, poses: DataFrame, prev_vocab: DataFrame) -> dict[str, DataFrame]:
    """Boundaries -> clips -> augmentation plan -> boundaries of derived files -> labels -> merged vocabulary."""
    points = materialize(segments.to_split_points(raw), "points")
    plan, counts = augment.plan_augment(videos, augs, existing)
    derived = plan.select(F.concat("aug_name", F.lit("_"), "stem", F.lit(".mp4")).alias("name"), F.lit("temporal").alias("aug_type"), "aug_name", "stem")
    scaled = segments.scale_segments(points, derived, params)
    valid = vocab.validate_poses(poses).where("valid")
    labels, skipped = segments.label_table(segments.single_gloss(valid, gloss_map, segments.segment_labels(points)))
    merged = vocab.merge_vocab(prev_vocab, labels.select(F.col("gloss").alias("token")))
    return {"clips": segments.clips(points, videos), "plan": plan, "plan_counts": counts, "derived": scaled, "labels": labels, "skipped": skipped, "vocabulary": merged}
