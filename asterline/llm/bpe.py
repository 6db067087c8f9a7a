"""BPE encoding and decoding by dynamic programming over prefixes.

The encoding of a prefix has one last token, and a token can be it exactly if the token before it, the last one of the
prefix that it leaves, is compatible: merging both texts together would leave the boundary between the two. So one pass over
a word stores the last token of every prefix, among the vocabulary entries that an automaton finds to end there, and
the ids are read off backwards.

Text goes through the vocabulary file's own steps first: added tokens, normal form, white space, lower case, split into
words and marks, bytes as characters, an end mark on the last. Results of words met before are kept in a bounded table.

Null text is empty and has no ids. Rows with equal ids are encoded one by one. Extra columns are not carried.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.llm.packing import byte_characters, per_worker

#: Words whose ids a worker keeps; beyond that it starts anew. Pairs of tokens likewise.
KEPT_WORDS = 700_000
KEPT_PAIRS = 1_000_000
LONG_WORD = 64
END = "\ue000"
#: White space as the vocabulary file's patterns have it (fixed by Unicode).
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NO_SPACES = re.compile(f"[^{SPACES}]+")
CONTROL_SPACES = re.compile("[\x1c-\x1f]")


class Vocabulary:
    """A BPE vocabulary with an end-of-word mark, from a file of the tokenizers library."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, suffix = whole["model"], whole["model"]["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in whole["added_tokens"]}
        size = max([*ids.values(), *added.values()]) + 1
        self.names = [""] * size
        for token, i in [*ids.items(), *added.items()]:
            self.names[i] = token
        self.added = added
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        pattern = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        # Which merge made a token (its rank, -1 for single characters), and of what.
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, a, b = ids[a + b], ids[a], ids[b]
            self.rank[a * size + b] = rank
            if self.born[i] < 0:
                self.born[i], self.left[i], self.right[i] = rank, a, b
        self.size = size
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            ends = token.endswith(suffix) and len(token) > len(suffix)
            body = token[: -len(suffix)] if ends else token
            self.automaton.add_word(body + END if ends else body, (i, len(body)))
        self.automaton.make_automaton()
        self.bytes = str.maketrans({b: c for b, c in enumerate(byte_characters())})
        self.pairs: dict[int, bool] = {}
        self.kept: dict[str, list[int]] = {}
        self.path, self.library = path, None
        self.assigned: set[str] = set(map(chr, range(128)))

    def compatible(self, a: int, b: int) -> bool:
        """Whether a then b keep their boundary when their texts are merged together.

        Merges are undone from the last one back. A pair across the boundary would have merged if its rank comes before
        the merges that took its two sides; of equal ranks the left one goes first.
        """
        never = len(self.born)
        a_taken = b_taken = never
        while True:
            rank = self.rank.get(a * self.size + b)
            if rank is not None and rank < a_taken and rank <= b_taken:
                return False
            if self.born[a] > self.born[b]:
                a_taken, a = self.born[a], self.right[a]
            elif self.born[b] >= 0:
                b_taken, b = self.born[b], self.left[b]
            else:
                return True

    def word(self, text: str) -> list[int]:
        """ids of one word: the last token of every prefix, then back from the end."""
        chars = text if text.isascii() else text.encode().decode("latin-1")
        return self._ids(chars.translate(self.bytes))

    def _ids(self, chars: str) -> list[int]:
        n, pairs, size = len(chars), self.pairs, self.size
        last, back = [-1] * (n + 1), [0] * (n + 1)
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        for at, (token, length) in self.automaton.iter(chars + END):
            # The last character only counts with its mark, which stands one place further.
            if at < n - 1:
                to = at + 1
            elif at == n:
                to = n
            else:
                continue
            if last[to] >= 0:
                continue
            start = to - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before * size + token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.compatible(before, token)
                if not fits:
                    continue
            last[to], back[to] = token, start
        out = []
        while n:
            out.append(last[n])
            n = back[n]
        out.reverse()
        return out

    def _known(self, text: str) -> bool:
        """Whether all characters are assigned in this Python's Unicode."""
        new = set(text) - self.assigned
        if any(unicodedata.category(c) == "Cn" for c in new):
            return False
        self.assigned |= new
        return True

    def _newer(self, text: str) -> list[int]:
        """Text with characters that only a newer Unicode may know is split by the tokenizers library's own tables."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        return [i for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal) for i in self._ids(w)]

    def _plain(self, text: str) -> list[int]:
        """ids of text without added tokens."""
        if text.isascii():
            text = text.lower()
        elif not self._known(text):
            return self._newer(text)
        else:
            # Lower case is taken by character: a capital sigma does not depend on its place.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        runs = NO_SPACES.findall(text) if CONTROL_SPACES.search(text) else text.split()
        kept, out = self.kept, []
        if len(kept) > KEPT_WORDS:
            kept.clear()
        get, more = kept.get, out.extend
        for run in runs:
            ids = get(run)
            if ids is None:
                ids = []
                for w in [run] if run.isascii() and run.isalpha() else self.words.findall(run):
                    part = get(w)
                    if part is None:
                        part = self.word(w)
                        if len(w) <= LONG_WORD:
                            kept[w] = part
                    ids += part
                if len(run) <= LONG_WORD:
                    kept[run] = ids
            more(ids)
        return out

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return self._plain(text)
        out: list[int] = []
        for part in self.specials.split(text):
            out += [self.added[part]] if part in self.added else self._plain(part)
        return out

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens with a space between them."""
        return " ".join(map(self.names.__getitem__, ids))


def encoded(docs: DataFrame, vocabulary: str, ident: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ids, decoded) of every text, after the columns of `keep`; decoded comes from the ids alone."""
    rows = docs.select(*keep, F.col(ident).alias("bpe_id"), F.coalesce(F.col(text), F.lit("")).alias("bpe_text"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.drop('bpe_text').schema)}, ids array<int>, decoded string"

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tool = per_worker(f"bpe_{vocabulary}", lambda: Vocabulary(vocabulary))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                ids = [tool.encode(t) for t in some.column(some.num_columns - 1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.fromiter((x for one in ids for x in one), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([tool.decode(x) for x in ids], pa.string())],
                    names=[*some.schema.names[:-1], "ids", "decoded"])

    return rows.mapInArrow(run, schema).withColumnRenamed("bpe_id", ident)
