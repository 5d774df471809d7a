"""The registered queries. Each runs over whole tables of ``sf_dir``."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowscribe.functions import fixed
from rowscribe.functions.values import default_if_falsy, joined_names, literal_names, truthy
from rowscribe.operators import chat, columns, order, render, tokens
from rowscribe.plans import job, views
from rowscribe.sources import datasets, preview, sinks
from rowscribe.sources.scratch import scratch_path
from rowscribe.streaming import logs

EOS = "</s>"
PAIR_KEYS = ["conv_id", "turn"]
SEED = 3407
VOCABULARY = 500
LENGTH = 64
PREAMBLE = "Below is an instruction that describes a task.\n\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pairs(table(spark, sf_dir, "conversations"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.movies(table(spark, sf_dir, "part"))


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.train_log(table(spark, sf_dir, "events"))


def joined(values: Column) -> Column:
    """Numbers as one text, which any engine compares alike."""
    return F.array_join(values.cast("array<string>"), ",")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, over all cores, for queries that split them into tokens."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return datasets.spread(rows, ["doc_id"])


# --- Sources and sinks -----------------------------------------------------


def load_split(spark, sf_dir):
    return datasets.load_split(
        spark, f"{sf_dir}/documents.parquet", "en", split_column="lang"
    ).select("doc_id", "lang", "text")


def pick_split(spark, sf_dir):
    every = datasets.load_split(spark, f"{sf_dir}/documents.parquet", None)
    return datasets.pick_split(every, "de", "lang").select("doc_id", "lang", "text")


def all_splits(spark, sf_dir):
    """Documents of all languages out of a folder for each."""
    path = scratch_path(spark, "splits")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("folder"))
    for name in [r[0] for r in rows.select("folder").distinct().collect()]:
        sinks.write_rows(rows.where(F.col("folder") == name), f"{path}/{name}")
    return datasets.load_all_splits(spark, path).select("doc_id", "text", "split")


def head_sample(spark, sf_dir):
    return datasets.load_split(
        spark, f"{sf_dir}/documents.parquet", None, num_samples=100, order_by=["doc_id"]
    )


def head_by_file(spark, sf_dir):
    return datasets.load_split(spark, f"{sf_dir}/documents.parquet", None, num_samples=150)


def head_of(format, **options):
    """The first documents of files of another format, in the order of files and rows."""

    def query(spark, sf_dir):
        path = scratch_path(spark, f"head-{format}")
        rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
        kept = rows if format != "text" else rows.select("doc_id", F.concat_ws("|", "doc_id", "lang", "source").alias("value"))
        ordered = kept.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
        written = ordered if format != "text" else ordered.select("value")
        written.write.format(format).options(**options).save(path)
        schema = "value string" if format == "text" else rows.schema
        read = datasets.load_split(spark, path, None, format=format, num_samples=333, schema=schema, **options)
        if format != "text":
            return read
        part = lambda i: F.split_part("value", F.lit("|"), F.lit(i))
        return read.select(part(1).cast("long").alias("doc_id"), part(2).alias("lang"), part(3).alias("source"))

    return query


def faulty_files(format, **options):
    """Files of documents of which the lines of one source are damaged: a folder for each language,
    the records it has and those that can't be read."""

    def query(spark, sf_dir):
        path = scratch_path(spark, f"faulty-{format}")
        rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
        if format == "json":
            whole = F.to_json(F.struct("doc_id", "lang", "source", "n_chars"))
            damaged = F.substring(whole, F.lit(1), F.length(whole) - 1)
        else:
            whole = F.concat_ws(",", "doc_id", "lang", "source", "n_chars")
            damaged = F.concat_ws(",", "doc_id", "lang", "source", F.lit("many"))
        value = F.when(F.col("source") == "src1", damaged).otherwise(whole).alias("value")
        rows.select("lang", value).write.partitionBy("lang").text(path)
        schema = rows.schema
        found = datasets.faulty_files(spark, f"{path}/*", format=format, schema=schema, **options)
        folder = F.regexp_extract("file", "lang=([^/]+)/[^/]+$", 1)
        lang = F.nullif(folder, F.lit("__HIVE_DEFAULT_PARTITION__")).alias("lang")
        return found.groupBy(lang).agg(F.sum("rows").alias("rows_read"), F.sum("bad").alias("bad"))

    return query


def round_trip(spark, sf_dir):
    path = scratch_path(spark, "round-trip")
    sinks.write_rows(alpaca(spark, sf_dir), path)
    return spark.read.parquet(path)


def sorted_round_trip(spark, sf_dir):
    path = scratch_path(spark, "sorted-json")
    rows = alpaca(spark, sf_dir)
    sinks.write_sorted(rows, path, PAIR_KEYS, files=4, format="json")
    return spark.read.schema(rows.schema).json(path)


def job_parameters(spark, sf_dir, **more):
    return job.JobParameters(
        f"{sf_dir}/documents.parquet", ["doc_id"], split=None, random_state=SEED, **more
    )


def whole_job(spark, sf_dir):
    """Load, render, order and write, then read what was written."""
    path = scratch_path(spark, "job")
    job.run(spark, job_parameters(spark, sf_dir, output_dir=path))
    return spark.read.parquet(path)


def sampled_job(spark, sf_dir):
    """A job over a seeded sample of its rows."""
    path = scratch_path(spark, "sampled-job")
    job.run(spark, job_parameters(spark, sf_dir, output_dir=path, shuffled_samples=100))
    return spark.read.parquet(path)


def tokenized_job(spark, sf_dir):
    """A job that writes ids and labels, with a vocabulary of the default size."""
    path = scratch_path(spark, "tokenized-job")
    job.run(spark, job_parameters(spark, sf_dir, output_dir=path, tokenize=True))
    rows = spark.read.parquet(path)
    return rows.select("doc_id", "position", joined(F.col("token_ids")).alias("ids"))


def head_of_split(spark, sf_dir):
    return datasets.load_split(
        spark, f"{sf_dir}/documents.parquet", "en", split_column="lang", num_samples=150
    )


def head_large(spark, sf_dir):
    """A head of more rows than a preview has."""
    return datasets.load_split(
        spark, f"{sf_dir}/lineitem.parquet", None, num_samples=3000, order_by=["l_orderkey", "l_linenumber"]
    )


def dry_job(spark, sf_dir):
    """The report of a job that computes all of its output and writes none."""
    report = job.run(spark, job_parameters(spark, sf_dir, dry_run=True, num_train_epochs=3.0))
    return spark.createDataFrame(
        [(report.rows, report.unrendered, report.steps)],
        "n_rows bigint, unrendered bigint, steps bigint",
    )


def preview_raw(spark, sf_dir):
    return preview.preview_raw(pairs(spark, sf_dir), PAIR_KEYS)


def preview_formatted(spark, sf_dir):
    return preview.preview_formatted(alpaca(spark, sf_dir), PAIR_KEYS)


# --- Columns ---------------------------------------------------------------


def column_report(spark, sf_dir):
    """What is detected in each of the tables' shapes."""
    found = {
        "documents": table(spark, sf_dir, "documents"),
        "pairs": pairs(spark, sf_dir),
        "chats": chat.assemble_chats(table(spark, sf_dir, "conversations")),
    }
    reports = [
        columns.report_columns(spark, columns.detect_columns(rows.columns)).withColumn("shape", F.lit(name))
        for name, rows in found.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def positional(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "lang", "doc_id")
    return render.render(rows, eos=EOS)


def forced_positional(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", "text", "source")
    return render.render(rows, "alpaca", eos=EOS)


def rename_content(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
    return render.render(rows)


def text_only(spark, sf_dir):
    return render.text_only(chats(spark, sf_dir))


# --- Renderers -------------------------------------------------------------


def auto_documents(spark, sf_dir):
    return render.render(table(spark, sf_dir, "documents"))


def alpaca(spark, sf_dir):
    return render.render(pairs(spark, sf_dir), "alpaca", eos=EOS)


def alpaca_without_input(spark, sf_dir):
    return render.render(pairs(spark, sf_dir).drop("input"), eos=EOS)


def movie(spark, sf_dir):
    return render.render(movies(spark, sf_dir), "movie_recommender", eos=EOS).select("id", "text")


def movie_notebook(spark, sf_dir):
    return render.text_only(render.render_movie(movies(spark, sf_dir), eos=""))


def movie_no_tagline(spark, sf_dir):
    rows = movies(spark, sf_dir).drop("tagline")
    return render.render(rows, "movie_recommender", eos=EOS).select("id", "text")


def chats(spark, sf_dir):
    assembled = chat.assemble_chats(table(spark, sf_dir, "conversations"))
    return assembled.select("conv_id", chat.render_chat(F.col("messages")).alias("text"))


def long_chats(spark, sf_dir):
    """Each 500 chats as one, in order of chat and turn."""
    turns = table(spark, sf_dir, "conversations").select(
        F.expr("conv_id div 500").alias("conv_id"),
        F.struct("conv_id", "turn").alias("turn"),
        "role",
        "text",
    )
    assembled = chat.assemble_chats(turns)
    return assembled.select("conv_id", chat.render_chat(F.col("messages")).alias("text"))


def detected_chats(spark, sf_dir):
    """Chats that are found by the name of their column."""
    assembled = chat.assemble_chats(table(spark, sf_dir, "conversations"))
    return render.render(assembled).select("conv_id", "text")


def assembled(spark, sf_dir):
    rows = chat.assemble_chats(table(spark, sf_dir, "conversations"))
    return rows.select(
        "conv_id",
        F.size("messages").cast("long").alias("turns"),
        F.array_join("messages.role", ",").alias("roles"),
    )


def passthrough(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return render.render(rows, "text")


def instruction_prompts(spark, sf_dir):
    prompt = render.instruction_prompt(F.col("instruction"), PREAMBLE)
    return pairs(spark, sf_dir).select(*PAIR_KEYS, prompt.alias("prompt"))


def generation_prompts(spark, sf_dir):
    prompt = chat.generation_prompt(F.col("instruction"))
    return pairs(spark, sf_dir).select(*PAIR_KEYS, prompt.alias("prompt"))


def sharegpt(spark, sf_dir):
    assembled = chat.assemble_chats(table(spark, sf_dir, "conversations"))
    speaker = {"user": "human", "assistant": "gpt"}
    theirs = F.transform(
        "messages",
        lambda m: F.struct(
            F.when(m["role"] == "user", speaker["user"])
            .when(m["role"] == "assistant", speaker["assistant"])
            .otherwise(m["role"])
            .alias("from"),
            m["content"].alias("value"),
        ),
    )
    rows = assembled.select("conv_id", theirs.alias("conversations"))
    turns = chat.normalize_turns(F.col("conversations"), rows.schema["conversations"].dataType)
    return rows.select("conv_id", chat.render_chat(turns).alias("text"))


def stripped(spark, sf_dir):
    rows = chats(spark, sf_dir)
    return rows.select("conv_id", chat.strip_special(F.col("text")).alias("text"))


# --- Values ----------------------------------------------------------------


def python_text(spark, sf_dir):
    """Doubles within and beyond the range Spark prints alike, dates with a
    fraction, nulls, booleans and numbers."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        (F.col("value") * 1000000).alias("large"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
        (F.col("event_type") == "error").alias("failed"),
        "props",
    )
    return rows.select(
        "event_id",
        *[
            render.text_of(rows, name).alias(f"{name}_text")
            for name in ("ts", "value", "large", "loss", "failed", "props")
        ],
    )


def python_text_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select(
        "o_orderkey",
        *[
            render.text_of(rows, name).alias(f"{name[2:]}_text")
            for name in ("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        ],
    )


def python_text_nested(spark, sf_dir):
    """Lists, structs and maps of numbers and of strings with quotes and line feeds."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.array("conv_id", "turn").alias("numbers"),
        F.array("role", "text").alias("strings"),
        F.struct(F.col("turn"), F.struct("role").alias("by")).alias("fields"),
        F.create_map("role", F.array("turn")).alias("entries"),
    )
    names = ("numbers", "strings", "fields", "entries")
    return rows.select("conv_id", "turn", *[render.text_of(rows, name).alias(f"{name}_text") for name in names])


def truth(spark, sf_dir):
    rows = movies(spark, sf_dir).select(
        "id", "tagline", "overview", (F.col("vote_count") % 3).alias("rest"), "runtime"
    )
    return rows.select(
        "id",
        *[
            truthy(F.col(name), rows.schema[name].dataType).cast("long").alias(f"{name}_true")
            for name in ("tagline", "overview", "rest", "runtime")
        ],
    )


def defaults(spark, sf_dir):
    rows = movies(spark, sf_dir)
    return rows.select(
        "id",
        *[
            default_if_falsy(F.col(name), rows.schema[name].dataType, default).alias(name)
            for name, default in (("overview", fixed.NO_OVERVIEW), ("tagline", fixed.NO_TAGLINE))
        ],
    )


def names(spark, sf_dir):
    return movies(spark, sf_dir).select(
        "id",
        F.size(literal_names(F.col("genres"))).cast("long").alias("n_genres"),
        F.array_join(literal_names(F.col("genres")), "|").alias("genres"),
        F.array_join(literal_names(F.col("keywords")), "|").alias("keywords"),
    )


def names_joined(spark, sf_dir):
    return movies(spark, sf_dir).select(
        "id",
        joined_names(F.col("genres")).alias("genres"),
        joined_names(F.col("keywords")).alias("keywords"),
    )


# --- Tokens ----------------------------------------------------------------


def vocabulary(spark, sf_dir):
    frame = tokens.build_vocabulary(documents(spark, sf_dir), "text", 1000).frame
    return frame.select(F.col("id").cast("long").alias("id"), "token", "count")


def vocabulary_large(spark, sf_dir):
    """Every token, ranked by many tasks."""
    frame = tokens.build_vocabulary(documents(spark, sf_dir), "text", 1_000_000).frame
    return frame.select(F.col("id").cast("long").alias("id"), "token", "count")


def encoded_pairs(spark, sf_dir):
    rows = render.render(pairs(spark, sf_dir), "alpaca", eos=EOS, parts=True)
    vocabulary = tokens.build_vocabulary(rows, "text", VOCABULARY)
    vocabulary = tokens.written(vocabulary, scratch_path(spark, "vocabulary"))
    return tokens.encode_with_labels(rows, vocabulary, LENGTH)


def encode(spark, sf_dir):
    return encoded_pairs(spark, sf_dir).select(*PAIR_KEYS, joined(F.col("token_ids")).alias("ids"))


def encode_documents(spark, sf_dir):
    """Whole documents, without a length limit."""
    rows = documents(spark, sf_dir)
    vocabulary = tokens.build_vocabulary(rows, "text", 1000)
    vocabulary = tokens.written(vocabulary, scratch_path(spark, "vocabulary"))
    encoded = tokens.encode(rows, "text", vocabulary, max_length=None)
    return encoded.select("doc_id", joined(F.col("token_ids")).alias("ids"))


def encode_documents_by_join(spark, sf_dir):
    """As above, by the way that a larger vocabulary takes."""
    rows = documents(spark, sf_dir)
    vocabulary = tokens.build_vocabulary(rows, "text", 1000)
    encoded = tokens.encode_by_join(rows, "text", vocabulary, None)
    return encoded.select("doc_id", joined(F.col("token_ids")).alias("ids"))


def encode_documents_large(spark, sf_dir):
    """Ids of a vocabulary of which a part is looked up and the rest joined."""
    rows = documents(spark, sf_dir)
    vocabulary = tokens.build_vocabulary(rows, "text", 300_000)
    vocabulary = tokens.written(vocabulary, scratch_path(spark, "vocabulary"))
    encoded = tokens.encode(rows, "text", vocabulary, max_length=None)
    return encoded.select("doc_id", joined(F.col("token_ids")).alias("ids"))


def truncate(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return rows.select("doc_id", F.array_join(tokens.tokens(F.col("text"), LENGTH), " ").alias("text"))


def labels(spark, sf_dir):
    return encoded_pairs(spark, sf_dir).select(*PAIR_KEYS, joined(F.col("labels")).alias("labels"))


# --- Order -----------------------------------------------------------------


def shuffle_take(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return order.shuffle_take(rows, 100, 42, ["doc_id"])


def batches(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order.assign_batches(rows, 2, 4, SEED, ["doc_id"])


def epochs(spark, sf_dir):
    """The place and step of each document in each of three passes."""
    rows = order.shuffled_position(table(spark, sf_dir, "documents").select("doc_id"), SEED, ["doc_id"])
    return order.epoch_batches(rows, 2, 4, 3, SEED)


def step_budget(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    by_epoch = order.step_budget(rows, 2, 4, epochs=3.0)
    return by_epoch.select(
        F.col("n_rows"),
        F.col("steps").alias("steps_by_epochs"),
        order.step_budget(rows, 2, 4, max_steps=60).select("steps").scalar().alias("steps_by_limit"),
    )


# --- Training log ----------------------------------------------------------


def log_lines(spark, sf_dir):
    return logs.with_log_line(train_log(spark, sf_dir)).select("step", "line")


def colon_lines(spark, sf_dir):
    rows = train_log(spark, sf_dir)
    step, loss = (rows.schema[name].dataType for name in ("step", "loss"))
    line = logs.log_line(F.col("step"), step, F.col("loss"), loss, fixed.LOG_LOSS_COLON)
    return rows.select("step", line.alias("line"))


def log_text(spark, sf_dir):
    return logs.log_chunks(log_lines(spark, sf_dir), ["step"])


def log_text_of_runs(spark, sf_dir):
    """Each kind of event as a run of its own."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    return logs.log_chunks(logs.with_log_line(rows), ["step"], run="run")


def log_text_stream(spark, sf_dir):
    """The logs of all runs out of a stream that is stopped and started again: records
    arrive in three parts, and what follows them ends after each."""
    records, log, progress = (scratch_path(spark, name) for name in ("records", "log", "log-state"))
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    third = (high - low) // 3 + 1
    for part in range(3):
        own = rows.where(F.expr(f"(step - {low}) div {third}") == part)
        own.write.mode("append").parquet(records)
        lines = logs.with_log_line(logs.read_log_stream(spark, records, rows.schema))
        logs.follow_log(lines, log, progress, ["step"], run="run", until_caught_up=True).awaitTermination()
    return logs.read_log(spark, log)


def event_stream(spark, sf_dir):
    # The pattern matches a single file as well as a folder of files.
    schema = table(spark, sf_dir, "events").schema
    return views.train_log(logs.read_log_stream(spark, f"{sf_dir}/events.parquet*", schema))


def log_stream(spark, sf_dir):
    """The stream, followed until it has read all records present."""
    lines = logs.with_log_line(event_stream(spark, sf_dir)).select("step", "line")
    path = scratch_path(spark, "log-lines")
    query = logs.append_lines(
        lines, path, scratch_path(spark, "log-progress"), until_caught_up=True
    )
    query.awaitTermination()
    return spark.read.schema(lines.schema).parquet(path)


def log_hook(spark, sf_dir):
    """The stream, handed batch by batch to a function."""
    lines = logs.with_log_line(event_stream(spark, sf_dir)).select("step", "line")
    path, commits, progress = (scratch_path(spark, f"hook-{name}") for name in ("lines", "commits", "progress"))
    hook = logs.once(spark, logs.append_batch(path), commits)
    logs.on_log(lines, hook, progress, until_caught_up=True).awaitTermination()
    return logs.read_committed(spark, path, commits).select("step", "line")


def every_kth(spark, sf_dir):
    return log_lines(spark, sf_dir).transform(logs.every_kth, 25)


QUERIES = {
    "s1_load_split": load_split,
    "s2_pick_split": pick_split,
    "s2_all_splits": all_splits,
    "s3_head_sample": head_sample,
    "s3_head_by_file": head_by_file,
    "s3_head_of_split": head_of_split,
    "s3_head_large": head_large,
    "s4_faulty_json": faulty_files("json"),
    "s4_faulty_csv": faulty_files("csv"),
    "s3_head_json": head_of("json"),
    "s3_head_csv": head_of("csv", header="true"),
    "s3_head_text": head_of("text"),
    "s3_head_orc": head_of("orc"),
    "s5_roundtrip": round_trip,
    "s5_sorted_json": sorted_round_trip,
    "s5_whole_job": whole_job,
    "s5_job_tokenized": tokenized_job,
    "o1_job_sample": sampled_job,
    "s6_dry_run": dry_job,
    "s7_preview_raw": preview_raw,
    "s8_preview_formatted": preview_formatted,
    "m8_column_report": column_report,
    "m6_positional_fallback": positional,
    "m7_forced_alpaca_positional": forced_positional,
    "p1_rename_content": rename_content,
    "p2_text_only": text_only,
    "f1_auto_documents": auto_documents,
    "f2_alpaca": alpaca,
    "f2_alpaca_no_input": alpaca_without_input,
    "f3_movie": movie,
    "f3_movie_notebook": movie_notebook,
    "f3_movie_no_tagline": movie_no_tagline,
    "f4_chat": chats,
    "f4_chat_long": long_chats,
    "m4_chat_detected": detected_chats,
    "f5_passthrough": passthrough,
    "f7_instruction_prompt": instruction_prompts,
    "f8_generation_prompt": generation_prompts,
    "f9_sharegpt": sharegpt,
    "f10_assemble": assembled,
    "f12_strip_special": stripped,
    "x1_py_str": python_text,
    "x1_py_str_orders": python_text_orders,
    "x1_py_str_nested": python_text_nested,
    "x2_truthy": truth,
    "x3_default_if_falsy": defaults,
    "x4_names": names,
    "x5_joined_names": names_joined,
    "t1_vocab": vocabulary,
    "t1_vocab_large": vocabulary_large,
    "t2_encode": encode,
    "t2_encode_documents": encode_documents,
    "t2_encode_join": encode_documents_by_join,
    "t2_encode_large": encode_documents_large,
    "t3_truncate": truncate,
    "t4_labels": labels,
    "o1_shuffle_take": shuffle_take,
    "o2_batches": batches,
    "o2_epochs": epochs,
    "o3_step_budget": step_budget,
    "l1_log_lines": log_lines,
    "l2_log_text": log_text,
    "l2_log_text_runs": log_text_of_runs,
    "l2_log_text_stream": log_text_stream,
    "l3_log_stream": log_stream,
    "l4_every_k": every_kth,
    "u4_log_hook": log_hook,
    "x7_log_line_colon": colon_lines,
}
