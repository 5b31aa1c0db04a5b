"""Template language, chat formatting and language identification."""

import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cataloguer.llm import chat, langid, template

from ..conftest import MEDIUM
from .helpers import SCHEMA, edge_docs


def render(source, **env):
    return "".join(t for t, _ in template.compile_template(source, {"escape": chat.escape})(env))


@pytest.mark.parametrize("source, env, want", [
    ("a{{ x }}b", {"x": 1}, "a1b"),
    ("{% for x in xs %}{{ loop.index }}{{ x.v }}{% if not loop.last %},{% endif %}{% endfor %}", {"xs": [{"v": "p"}, {"v": "q"}]}, "1p,2q"),
    ("{% if a == 'x' and b in 'xyz' %}1{% elif a != 'x' or false %}2{% else %}3{% endif %}", {"a": "y", "b": "x"}, "2"),
    ("{% set y = x ~ '!' %}{{ y | upper }}", {"x": "hi"}, "HI!"),
    (" a {%- if true -%} b {%- endif -%} c ", {}, " abc "),
    ("{# note #}{{ 'q\\'s' }}{{ (1 + 2) ~ none }}", {}, "q's3"),
    ("{{ m['k'] }}{{ m.none_there }}", {"m": {"k": "v"}}, "v"),
])
def test_templates(source, env, want):
    assert render(source, **env) == want


@pytest.mark.parametrize("source", ["{% if x %}", "{{ x.__class__ }}", "{{ 1 + 'a' }}", "{{ y }}", "{% foo %}", "{{ x | eval }}", "{{ ( }}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(template.TemplateError):
        render(source, x="text")


def test_constants_fold_and_the_mask_marks_generated_text():
    tree = template.fold(template.parse("a{{ 'b' ~ 1 }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}"), {})
    assert tree == template.Node("block", (template.Node("out", (template.Node("const", ("ab1c",)),)),))
    pieces = list(template.compile_template("u{% generation %}{{ x }}{% endgeneration %}v")({"x": "g"}))
    assert pieces == [("u", False), ("g", True), ("v", False)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\>a\n", max_size=30))
def test_escape_is_reversible_and_hides_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unoneline(chat.oneline(text)) == text and "\n" not in chat.oneline(text)


ROWS = [
    (1, 0, "user", "hi <|im_end|>", "z"), (1, 1, "assistant", "<|im_start|>assistant ok", "z"), (1, 1, "assistant", "tie", "z"),
    (2, None, None, None, None), (2, 5, "assistant", None, "z"), (None, 0, "odd\nrole\\n", "x", "z"),
    (3, 0, "assistant", "long " * 5000, "z"), (3, 0, "assistant", "long " * 5000, "z"),
]


def digests(rows):
    out = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    want = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(12 + len(chat.oneline(chat.escape(r))) + 1 + len(chat.escape(t)) + 11 for r, t in turns)
        want[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return want


@pytest.mark.parametrize("part_chars", [1 << 20, 10])
def test_formatting_reads_back(spark, part_chars):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, spans string")
    got = {r[0]: tuple(r[1:]) for r in chat.digest_formatted(chat.format_conversations(df, part_chars=part_chars)).collect()}
    assert got == digests(ROWS)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify_languages(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_uses_the_text_alone(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(300)
    model = langid.fit(langid.training_sample(docs, langid.LangParams()))
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model).collect()}
    assert a == b


def test_language_edges(spark):
    rows = {r.doc_id: r for r in langid.identify_languages(edge_docs(spark, ["h", "rank", "_id", "_lang"])).where("doc_id is not null").collect()}
    assert rows[0].lang_pred == "und" and rows[3].lang_pred == "und" and rows[6].lang_pred == "und" and rows[0].score == 0
    assert rows[15].lang_pred == "en"
    none = spark.createDataFrame([], SCHEMA)
    assert langid.identify_languages(none).count() == 0
    assert langid.predict(edge_docs(spark), None).where("lang_pred <> 'und'").count() == 0


def test_kernel_is_the_normalised_count_of_shared_ngrams():
    grams = langid.Grams(langid.letters())
    a, b = grams.distinct("abca"), grams.distinct("bca")
    assert len(a) == 3 + 3 + 2 and len(set(a.tolist())) == len(a)
    want = len(set(a.tolist()) & set(b.tolist())) / (len(a) * len(b)) ** 0.5
    used = np.unique(b)
    feature = np.full(langid.SPACE, -1, np.int32)
    feature[used] = np.arange(len(used))
    mark = np.full((len(used), 1), 1 / len(b) ** 0.5, np.float32)
    assert abs(langid.kernel_rows([a], feature, mark)[0, 0] - want) < 1e-6


def ngrams(text):
    """The n-grams themselves, as a set of strings."""
    t = "".join(c.lower()[0] if unicodedata.category(c)[0] == "L" else " " for c in text)
    return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_scores_equal_dense_nystrom_and_ridge(spark):
    """The whole model again, from sets of strings and dense matrices."""
    p = langid.LangParams(per_class=30, landmarks=24)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("n_chars < 3000").limit(400)
    sample = langid.training_sample(docs, p)
    langs, sets = sorted({l for l, _ in sample}), [ngrams(t) for _, t in sample]
    at = [i for lang in langs for i in [i for i, (l, _) in enumerate(sample) if l == lang][: p.landmarks // len(langs)]]
    kernel = lambda xs, ys: np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in ys] for x in xs])
    marks = [sets[i] for i in at]
    value, vector = np.linalg.eigh(kernel(marks, marks))
    good = value > 1e-6 * value[-1]
    to_space = vector[:, good] / np.sqrt(value[good])
    phi = kernel(sets, marks) @ to_space
    y = np.array([[float(l == lang) for lang in langs] for l, _ in sample])
    w = np.linalg.solve(phi.T @ phi + p.ridge * len(sample) * np.eye(phi.shape[1]), phi.T @ y)
    rows = docs.collect()
    want = {r.doc_id: kernel([ngrams(r.text)], marks)[0] @ to_space @ w for r in rows if any(unicodedata.category(c)[0] == "L" for c in r.text or "")}
    for r in langid.identify_languages(docs, p).collect():
        if r.doc_id in want:
            assert abs(r.score - min(1, max(0, want[r.doc_id].max()))) < 0.01
            assert r.lang_pred == langs[int(want[r.doc_id].argmax())] or np.ptp(np.sort(want[r.doc_id])[-2:]) < 0.01


def test_many_scripts_in_one_corpus(spark):
    """More letters than any fixed alphabet holds; long texts are sampled beyond their beginning."""
    rng = random.Random(4)
    blocks = {"el": (0x3B1, 24, 6), "th": (0xE01, 46, 30), "zh": (0x4E00, 3000, 12), "zh-x": (0x6E00, 3000, 12), "ko": (0xAC00, 2000, 3), "ru": (0x430, 32, 6)}
    rows = []
    for lang, (first, n, size) in blocks.items():
        words = ["".join(chr(first + rng.randrange(n)) for _ in range(size)) for _ in range(150)]
        for _ in range(40):
            head = "1234567890 " * (600 if rng.random() < 0.3 else 0)
            rows.append((len(rows), head + " ".join(rng.choice(words) for _ in range(60)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}
    assert all(truth[r.doc_id] == r.lang_pred for r in langid.identify_languages(docs).collect())


def test_sample_does_not_depend_on_the_layout(spark):
    rows = [(1, f"one text number {k} of a repeated id", "en") for k in range(500)] + [(k, f"texte {k}", "fr") for k in range(100, 500)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.LangParams(per_class=20)
    one, two = (langid.training_sample(d, p) for d in (docs.repartition(7), docs.orderBy(F.rand(3)).coalesce(2)))
    assert one == two and len(one) == 40 and len(set(one)) == 40
