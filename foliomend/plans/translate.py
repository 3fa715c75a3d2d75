"""Translation of whole documents: protect, split, pack, call, check, retry, fall back, merge, restore."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomend.functions import text as T
from foliomend.operators import nodes as N
from foliomend.operators import placeholders as P
from foliomend.plans.config import TranslateConfig, default_config
from foliomend.sources import sinks
from foliomend.sources.shared import discard
from foliomend.sources.shared import written_and_cleaned as written

LOG = logging.getLogger(__name__)
#: A translator: (text, source language, target language) to text.
Translator = Callable[[str, str | None, str], str]

# The instruction given to a language model.
RULES = "You translate Markdown. Keep every __PH_..__ placeholder and every <NODE_START_dddd>, </NODE_END_dddd> mark exactly as it is, translate only readable text, add nothing."
TASK = "<task><source>{source}</source><target>{target}</target><text><![CDATA[{text}]]></text></task>"


def echo(text: str, source: str | None, target: str) -> str:
    """The text as it is: a dry run."""
    return text


def prompt(text: Column, source: str | None, target: str) -> Column:
    """The task for one group, safe inside CDATA."""
    before, after = TASK.format(source=source or "", target=target, text="\0").split("\0")
    return F.concat(F.lit(before), T.wrap_cdata(text), F.lit(after))


class Ollama:
    """A translator that calls a model by the `ollama` package; on failure the text comes back as it is.

    options: model, and host, retry_times (3) if wanted. Each task has one client, for all its calls.
    """

    def __init__(self, options: dict):
        if not options.get("model"):
            raise ValueError("translator_config names no model")
        self.model, self.host = options["model"], options.get("host", "http://localhost:11434")
        self.tries = int(options.get("retry_times", 3))
        self.name = f"ollama {self.model}"
        self.client = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"client": None}

    def connect(self):  # noqa: ANN201  the package need not be there
        from ollama import Client

        return Client(host=self.host)

    def __call__(self, text: str, source: str | None, target: str) -> str:
        task = TASK.format(source=source or "", target=target, text=text.replace("]]>", "]]]]><![CDATA[>"))
        messages = [{"role": "system", "content": RULES}, {"role": "user", "content": task}]
        for k in range(1, self.tries + 1):
            try:
                self.client = self.client or self.connect()
                return self.client.chat(model=self.model, messages=messages)["message"]["content"]
            except Exception as e:  # noqa: BLE001  whatever the network or the model does
                LOG.warning("call %d of %d failed: %s", k, self.tries, e)
                time.sleep(1 + 1.5 * k)
        return text


def translator_for(cfg: TranslateConfig, options: dict | None = None) -> Translator:
    if cfg.translator_type == "echo":
        return echo
    if cfg.translator_type == "ollama":
        return Ollama(options or {})
    raise ValueError(f"unknown translator: {cfg.translator_type}")


def model_name(translator: Translator) -> str:
    """What tells one translator's answers from another's."""
    return getattr(translator, "name", None) or getattr(translator, "__qualname__", None) or type(translator).__qualname__


class Kept:
    """Answers that are kept in a folder, by a hash of model, languages, round and payload.

    A call's answer is a file of its own from the moment it is there, so a task that runs again, or a job
    that is started again, finds it. What a round has answered is also a table, which the next start
    joins before it makes any task. An answer equal to its payload is what a client gives that failed: it isn't kept.
    """

    def __init__(self, root: str):
        self.root = root

    def table(self, spark: SparkSession) -> DataFrame:
        return sinks.manifest(spark, f"{self.root}/rounds", "key string, answer string")

    def save(self, answers: DataFrame) -> None:
        answers.select("key", "answer").write.parquet(f"{self.root}/rounds/{sinks.MANIFEST}/{uuid.uuid4().hex}")

    def path(self, key: str) -> str:
        return f"calls/{key[:3]}/{key}"


def keys_of(payload: Column, translator: Translator, cfg: TranslateConfig, turn: int) -> Column:
    what = "\0".join([model_name(translator), cfg.source_lang or "", cfg.target_lang, str(turn)])
    return F.sha2(F.concat(F.lit(what + "\0"), payload), 256)


def call_groups(groups: DataFrame, translator: Translator, cfg: TranslateConfig, turn: int = 0, kept: Kept | None = None, calls: int | None = None) -> DataFrame:
    """doc_id, group_id, payload: each group through the translator, as answers_to does it."""
    rows = written(groups.select("doc_id", "group_id", "payload", keys_of(F.col("payload"), translator, cfg, turn).alias("key")), "rows")
    answers = answers_to(rows, translator, cfg, kept, calls).withColumn("real", F.lit(True))
    return rows.join(answers, "key", "left").select("doc_id", "group_id", F.when(F.col("real"), F.col("answer")).otherwise(F.col("payload")).alias("payload"))


def answers_to(rows: DataFrame, translator: Translator, cfg: TranslateConfig, kept: Kept | None = None, calls: int | None = None, spare: list[DataFrame] | None = None) -> DataFrame:
    """key, answer: of rows' payloads those whose answer is another text than the payload; equal payloads are asked once.

    parallel_groups calls of a task go at a time. calls: how many at a time in all; then there are no
    more tasks than that allows. kept: answers of earlier runs, which are not asked for again. Answers are
    written before anything reads them, so that no later stage calls again; spare: takes that table.
    """
    todo = rows.groupBy("key").agg(F.first("payload").alias("payload"))
    have = kept.table(rows.sparkSession) if kept else None
    if kept:
        todo = todo.join(have.select("key"), "key", "left_anti")
    if calls:
        todo = todo.repartition(max(1, calls // max(1, cfg.parallel_groups)))
    width = max(1, cfg.parallel_groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = sinks.Folder(kept.root) if kept else None

        def answer(key: str, payload: str) -> str:
            found = translator(payload, cfg.source_lang, cfg.target_lang)
            if folder and found is not None and found != payload:
                folder.put(kept.path(key), found.encode())
            return found

        with ThreadPoolExecutor(width) as pool:
            for batch in batches:
                for part in (batch.slice(at, 16 * width) for at in range(0, batch.num_rows, 16 * width)):
                    keys, payloads = part.column(0).to_pylist(), part.column(1).to_pylist()
                    there = folder.get([kept.path(k) for k in keys]) if folder else [None] * len(keys)
                    found = list(pool.map(lambda k, p, t: answer(k, p) if t is None else t.decode(), keys, payloads, there))
                    real = [k for k, (a, p) in enumerate(zip(found, payloads)) if a != p]
                    yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in real], pa.string()), pa.array([found[k] for k in real], pa.string())], ["key", "answer"])

    answers = written(todo.select("key", "payload").mapInArrow(run, "key string, answer string"), "groups")
    if spare is not None:
        spare.append(answers)
    if kept:
        kept.save(answers)
        answers = answers.unionByName(have)
    return answers


def translate(docs: DataFrame, cfg: TranslateConfig | None = None, translator: Translator | None = None, text_col: str = "md", kept: str | None = None, calls: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, nodes, protected) of docs (doc_id, text_col). kept: a folder for answers, which a run that
    is started again finds; calls: how many calls may go at a time in all. See answers_to.

    texts: doc_id, text. nodes: doc_id, nid, origin, translated, outcome (skipped, translated, retried or
    failed). protected: doc_id, protected, store. Nodes without readable text are skipped. Failed nodes
    are tried again in smaller groups, at most retry_times rounds, and keep their original at last. A
    document without nodes gets an empty text.

    A document's nodes stay in its row: those that are open, and those that are done. Each round writes
    these rows anew and removes those of the round before, and its answers, so that the disk holds two of them at
    most. A translation that is its original to the character takes no room; where all answers are their
    payloads, no text is shuffled but payloads on their way to the translator.
    """
    cfg = cfg or default_config()
    translator = translator or translator_for(cfg)
    answers_of = Kept(sinks.address(docs.sparkSession, kept)) if kept else None
    protected = written(P.protect(docs, cfg, text_col).withColumn("row", F.monotonically_increasing_id()), "protected")
    rows = _opened(protected, cfg)
    for turn in range(cfg.retry_times + 1 if cfg.retry_failed_nodes else 1):
        if turn and not rows.where("size(open) > 0").head(1):
            break
        rows = _round(rows, translator, cfg, turn, answers_of, calls)
    failed = F.transform("open", lambda n: F.struct(n["nid"].alias("nid"), n["origin"].alias("origin"), F.lit(None).cast("string").alias("translated"), F.lit(True).alias("same"), F.lit("failed").alias("outcome")))
    rows = rows.select("row", "doc_id", F.array_sort(F.concat("done", failed)).alias("nodes"))
    nodes = rows.select("doc_id", F.explode_outer("nodes").alias("n")).where("n IS NOT NULL").select("doc_id", "n.nid", "n.origin", _text(F.col("n")).alias("translated"), "n.outcome")
    merged = rows.select("row", F.array_join(F.transform("nodes", lambda n: F.concat(F.lit("\n\n"), _text(n), F.lit("\n\n"))), "").alias("text"))
    texts = protected.select("row", "doc_id", "store").join(merged, "row").select("doc_id", T.collapse_newlines(P.restore(F.col("text"), F.col("store"))).alias("text"))
    return texts, nodes, protected.drop("row")


#: An open node; same: whether what came back is the original, which then isn't repeated. A node that is done has an outcome too.
OPEN = "array<struct<nid:int,origin:string,translated:string,same:boolean>>"
DONE = OPEN.replace("same:boolean", "same:boolean,outcome:string")


def _text(n: Column) -> Column:
    """What came back for a node."""
    return F.when(n["same"], n["origin"]).otherwise(n["translated"])


def _node(r: Column, translated: Column, same: Column, *more: Column) -> Column:
    return F.struct(r["nid"].alias("nid"), r["origin"].alias("origin"), translated.alias("translated"), same.alias("same"), *more)


def _opened(protected: DataFrame, cfg: TranslateConfig) -> DataFrame:
    """row, doc_id, open, done, settled: the nodes before the first round; those with nothing to read are done."""
    found = N.node_arrays(protected, cfg.max_chunk_chars, keys=("row", "doc_id"))
    found = found.select("row", "doc_id", F.transform("origins", lambda x, i: F.struct(i.alias("nid"), x.alias("origin"), T.is_placeholder_only(x).alias("skip"))).alias("all"))
    nothing = F.lit(None).cast("string")
    todo = F.transform(F.filter("all", lambda r: ~r["skip"]), lambda r: _node(r, nothing, F.lit(False)))
    skipped = F.transform(F.filter("all", lambda r: r["skip"]), lambda r: _node(r, nothing, F.lit(True), F.lit("skipped").alias("outcome")))
    return written(found.select("row", "doc_id", todo.cast(OPEN).alias("open"), skipped.cast(DONE).alias("done"), F.lit(False).alias("settled")), "round")


def _settled(n: Column) -> Column:
    """Whether another round in which all answers are their payloads would leave an open node as it is."""
    return ~n["origin"].contains("NODE_") & _text(n).eqNullSafe(N.echo_of(n["origin"]))


def _round(rows: DataFrame, translator: Translator, cfg: TranslateConfig, turn: int, kept: Kept | None, calls: int | None) -> DataFrame:
    """rows (row, doc_id, open, done, settled) after a round, written; the ones before go. settled: whether
    answers that are their payloads would change nothing more; if all rows are, and all answers, rows stay."""
    most, spare = max(1024, cfg.max_chunk_chars // 2) if turn else cfg.max_chunk_chars, []
    groups = N.cut_groups(rows.withColumnRenamed("open", "rows"), most, N.group_cost)
    payloads = groups.select("row", F.posexplode_outer(F.transform("groups", N.group_text)).alias("group_id", "payload")).where("group_id IS NOT NULL")
    payloads = payloads.withColumn("key", keys_of(F.col("payload"), translator, cfg, turn))
    answers = answers_to(payloads, translator, cfg, kept, calls, spare)
    answered = bool(answers.head(1))
    if turn and not answered and not rows.where("NOT settled").head(1):
        discard(spare[0])
        return rows
    marked = F.exists(F.flatten("groups"), lambda r: r["origin"].contains("NODE_"))
    if answered:
        back = payloads.select("row", "group_id", "key").join(answers, "key").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("group_id", "answer"))).alias("back"))
        groups = groups.join(back, "row", "left")
        marked = marked | F.col("back").isNotNull()
    else:
        groups = groups.withColumn("back", F.lit(None).cast("array<struct<group_id:int,answer:string>>"))
    # As a rule a row of answers stands at its group's number.
    place = lambda k: T.bound(F.get("back", k), lambda b: F.when(b["group_id"] == k, b).otherwise(F.get(F.filter("back", lambda x: x["group_id"] == k), F.lit(0))))
    texts = F.transform("groups", lambda g, k: T.bound(place(k), lambda b: F.when(b.isNull(), N.group_text(g)).otherwise(b["answer"])))
    found = groups.select("row", "doc_id", "done", F.when(marked, N.matched(F.col("groups"), texts)).otherwise(N.echoed(F.col("groups"))).alias("found"))

    def tried(f: Column) -> Column:
        """A node with what came back, or what was there where nothing did; an answer that has failed already fails again."""
        r = f["row"]
        return T.bound(F.coalesce(f["new"], _text(r)), lambda now: F.struct(r.alias("row"), now.alias("now"), (F.lit(turn > 0) & now.eqNullSafe(_text(r))).alias("again")))

    found = found.select("row", "doc_id", "done", F.transform("found", tried).alias("tried"))
    pairs = F.transform("tried", lambda t: F.when(t["again"], F.array(F.lit("1"))).otherwise(N.compared(t["row"]["origin"], t["now"], cfg.target_lang, readable=True)))
    found = found.withColumn("alike", N.similarities(pairs))
    ok = lambda k: F.get("alike", k) < N.ALIKE
    node = lambda t, *more: T.bound(t["now"].eqNullSafe(t["row"]["origin"]), lambda same: _node(t["row"], F.when(~same, t["now"]), same, *more))
    stay = F.transform(F.filter("tried", lambda t, k: ~ok(k)), lambda t: node(t))
    fine = F.transform(F.filter("tried", lambda t, k: ok(k)), lambda t: node(t, F.lit("retried" if turn else "translated").alias("outcome")))
    found = found.select("row", "doc_id", stay.cast(OPEN).alias("open"), F.concat("done", fine).cast(DONE).alias("done"))
    after = written(found.withColumn("settled", F.forall("open", _settled)), "round")
    for table in [rows, *spare]:
        discard(table)
    return after


def outcomes(nodes: DataFrame) -> DataFrame:
    """doc_id, skipped, translated, retried, failed: how many nodes of each document went which way."""
    count = lambda k: F.count_if(F.col("outcome") == k).alias(k)
    return nodes.groupBy("doc_id").agg(*map(count, ("skipped", "translated", "retried", "failed")))


def outputs(texts: DataFrame, nodes: DataFrame, protected: DataFrame) -> list[tuple[str, DataFrame, str]]:
    """What a translation leaves, for writing: (end of the file's name, doc_id and a text, that column)."""
    return [
        (".md", texts, "text"),
        (".protected.md", protected, "protected"),
        (".protected.json", protected.select("doc_id", P.store_json(F.col("store")).alias("json")), "json"),
        (".nodes.json", N.nodes_json(nodes), "nodes"),
    ]
