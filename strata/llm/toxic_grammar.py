"""The weighted pattern grammar: small transducers over token classes, and their composition.

A text is cut into clauses of tokens; each token has a class (insult, threat, target,
negation, reporting word, ...). Every transducer reads the classes of a clause and tags
what it knows about a token: which target stands near, whether a verb of being, an article,
a negation or a reporting word governs it. Composition runs all of them side by side as one
transition table, whose outputs are the matched patterns, e.g. a targeted insult or a
reported threat. A hostile word that nothing in its clause governs matches no pattern, and
a clause counts once, as the strongest pattern in it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

# token classes
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, AGENT, LEARNT, BEING, ARTICLE = range(10)

# words of each class in English, German, French and Spanish
WORDS: dict[int, str] = {
    INSULT: """
        idiot idiots idiotic moron morons stupid dumb fool fools loser losers scum trash garbage clown clowns pathetic
        worthless disgusting useless imbecile filth filthy vermin pig pigs rat rats scumbag jerk coward cowards liar liars
        idioten dumm dummkopf blöd blödmann trottel abschaum versager widerlich erbärmlich wertlos drecksack schwein arschloch
        imbécile imbéciles crétin crétins débile nul nulle ordure racaille minable dégoûtant pathétique connard salaud
        idiota idiotas estúpido estúpida imbécil basura escoria patético patética asqueroso asquerosa inútil payaso cobarde
    """,
    THREAT: """
        kill killing destroy hurt beat smash burn stab shoot strangle crush punch bury hang
        töten umbringen vernichten schlagen verprügeln zerstören verbrennen erschießen
        tuer détruire frapper écraser brûler étrangler massacrer
        matar destruir golpear quemar aplastar estrangular
    """,
    TARGET: """
        you your yours yourself youre he him she they them these those people everyone
        du dich dir dein deine ihr euch eure sie ihn
        tu toi te vous ton ta tes votre vos ils eux
        tú ti usted ustedes vosotros ellos ellas él
    """,
    NEGATION: """
        not never no nobody isnt arent wasnt without neither nor
        nicht nie niemals kein keine niemand ohne weder
        pas jamais aucun aucune personne sans ni
        nunca jamás ningún ninguna nadie sin tampoco
    """,
    REPORT: """
        said says saying claimed claims wrote called reported quoted allegedly according heard
        sagte sagt behauptete schrieb nannte angeblich laut
        dit disait écrit affirmé prétendu selon aurait
        dijo dice afirmó escribió llamó según supuestamente
    """,
    AGENT: "i we ill well gonna will shall ich wir werde werden je nous vais allons yo nosotros voy vamos",
    BEING: """
        is are was were be been am become like ist sind war waren bist seid bin sein wie
        est sont était étaient es suis êtes être comme eres son era eran soy ser como
    """,
    ARTICLE: """
        the a an this that such every some all my our its of by with for der die das den dem des ein eine einen einer dieser diese dieses von
        le la les un une des ce cette cet ces du de el los las una unos unas este esta del al
    """,
}

TOKEN = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:\n|]+")

Step = Callable[[int, int], tuple[int, str]]


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: a start state and (state, class) -> (state, tag)."""

    start: int
    step: Step


def _scope(opener: int, length: int, tag: str) -> Transducer:
    """Tags every token within ``length`` tokens after a token of class ``opener``."""

    def step(state: int, token: int) -> tuple[int, str]:
        if token == opener:
            return length, ""
        return max(0, state - 1), tag if state else ""

    return Transducer(0, step)


def _hits() -> Transducer:
    """Tags the hostile tokens, and a target that follows one within three tokens."""

    def step(state: int, token: int) -> tuple[int, str]:
        if token in HITS:
            return 3, HITS[token]
        if token == TARGET and state:
            return 0, "then-target"
        return max(0, state - 1), ""

    return Transducer(0, step)


def _opening() -> Transducer:
    """Tags the first token of a clause: a call or a command."""
    return Transducer(0, lambda state, token: (1, "" if state else "first"))


def _again() -> Transducer:
    """Tags hostile tokens after the first of their clause."""

    def step(state: int, token: int) -> tuple[int, str]:
        hit = token in HITS
        return int(state or hit), "again" if state and hit else ""

    return Transducer(0, step)


HITS = {INSULT: "insult", THREAT: "threat", LEARNT: "learnt"}

GRAMMAR = (
    _hits(), _opening(), _again(), _scope(TARGET, 4, "target"), _scope(AGENT, 3, "agent"), _scope(BEING, 4, "being"),
    _scope(ARTICLE, 3, "article"), _scope(NEGATION, 3, "negated"), _scope(REPORT, 6, "reported"),
)

# the patterns that composition can give out, the weakest first, in the order of the features
PATTERNS = (
    "negated", "reported", "named insult", "named learnt", "repeated insult", "repeated learnt",
    "predicated insult", "predicated learnt", "called insult", "called learnt",
    "targeted insult", "targeted learnt", "commanded threat", "directed threat",
)

# what governs an insult or learnt word, the strongest first
GOVERNORS = (("target", "targeted"), ("first", "called"), ("being", "predicated"), ("again", "repeated"), ("article", "named"))


def _pattern(tags: tuple[str, ...]) -> str:
    """The matched pattern of one token's tags; empty for none, a kind of hit that a later target may complete."""
    found = set(tags)
    if "then-target" in found:
        return "then-target"
    hit = next((h for h in HITS.values() if h in found), None)
    if hit is None:
        return ""
    for tag in ("negated", "reported"):
        if tag in found:
            return tag
    if hit == "threat":
        return "directed threat" if found & {"target", "agent"} else "commanded threat" if "first" in found else ""
    return next((f"{name} {hit}" for tag, name in GOVERNORS if tag in found), "")


COMPLETED = {INSULT: "targeted insult", LEARNT: "targeted learnt", THREAT: "directed threat"}


@cache
def composed() -> tuple[list[list[int]], list[list[str]]]:
    """Transition and output tables [state][class] of all transducers run side by side."""
    first = tuple(t.start for t in GRAMMAR)
    number, todo = {first: 0}, [first]
    moves: list[list[int]] = []
    outputs: list[list[str]] = []
    for states in todo:
        row, out = [], []
        for token in range(len(WORDS) + 2):
            after, tags = zip(*(t.step(s, token) for t, s in zip(GRAMMAR, states)))
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
            out.append(_pattern(tags))
        moves.append(row)
        outputs.append(out)
    return moves, outputs


class Lexicon:
    """Class and weight of every word: the written lists, and stems learnt from labels."""

    def __init__(self, learnt: dict[str, float], memo_words: int = 200_000) -> None:
        self.written = {w: kind for kind, words in WORDS.items() for w in words.split()}
        self.learnt = learnt
        self.lengths = sorted({len(s) for s in learnt if len(s) <= max(STEMS)})
        self.memo: dict[str, tuple[int, float]] = {}
        self.memo_words = memo_words

    def _find(self, word: str) -> tuple[int, float]:
        kind = self.written.get(word, OTHER)
        if kind != OTHER:
            return kind, 1.0
        weight = max([self.learnt.get(word, 0.0), *(self.learnt.get(word[:n] + STEM, 0.0) for n in STEMS if len(word) > n)])
        return (LEARNT, weight) if weight else (OTHER, 0.0)

    def __call__(self, word: str) -> tuple[int, float]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= self.memo_words:
                self.memo.clear()
            found = self.memo[word] = self._find(word)
        return found


STEMS = (4, 5, 6)
STEM = "*"


def word_features(word: str) -> list[str]:
    """The word and its stems, as keys of the learnt lexicon."""
    return [word, *(word[:n] + STEM for n in STEMS if len(word) > n)]


def clause_pattern(kinds: list[tuple[int, float]]) -> tuple[int, float]:
    """The strongest pattern (-1 for none) of a clause of (class, weight) tokens, and the weight of its hostile word."""
    moves, outputs = composed()
    best, state, hit = (-1, 0.0), 0, (OTHER, 0.0, "")
    for kind, weight in kinds:
        found = outputs[state][kind]
        state = moves[state][kind]
        if kind in HITS:
            hit = kind, weight, found
        elif found:  # a target right after the last hit; what negates or reports the hit stays in force
            found = hit[2] if hit[2] in ("negated", "reported") else COMPLETED[hit[0]]
            weight = hit[1]
        if found:
            best = max(best, (STRENGTH[found], weight))
    return best


STRENGTH = {name: at for at, name in enumerate(PATTERNS)}


def pattern_weights(text: str, lexicon: Lexicon) -> list[float]:
    """Summed weight of every pattern over the matched clauses of a whole text."""
    sums = [0.0] * len(PATTERNS)
    text = text.lower()
    if not any(lexicon(word)[0] in HITS for word in set(TOKEN.findall(text))):
        return sums
    for clause in CLAUSE.findall(text):
        kinds = [lexicon(word) for word in TOKEN.findall(clause)]
        if any(kind in HITS for kind, _ in kinds):
            pattern, weight = clause_pattern(kinds)
            if pattern >= 0:
                sums[pattern] += weight
    return sums
