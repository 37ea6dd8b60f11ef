"""Prompt texts as Column expressions over joined context."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .hashing import hash_order

# --- fixed values: scenario guidance and the fixed sentences of the five templates ----------------
GUIDANCE = {
    "Weiterbildungskursbeschreibung": [
        "Schreibe einen kurzen Fließtext (1-2 Sätze) im Präsens, der das Angebot anschaulich beschreibt.",
        "Betone Praxisnutzen und Zielgruppe klar."],
    "Kursinhalte": ["Beschreibe detailiert welche Themen in dem Kurs behandelt werden."],
    "Lernzielbeschreibung": [
        "Die Überschrift lautet 'Teilnehmende lernen in diesem Kurs:'. Formuliere den darauf folgenden kruzen und prägnanten Text.",
        "Kann Fließtext mit maximal 1-3 präzisen Sätzen sein oder eine Auflistung begonnen mit '- '"],
    "Lernergebnis": [
        "Nach erfolgreichem Abschluss, wird ein Zertifikat ausgestellt. Darauf steht was die Teilnehmenden gelernt haben.",
        "Formuliere den Satz so, dass klar wird, was die Teilnehmenden am Ende des Kurses können."],
    "Jobprofil-Zusammenfassung": [
        "Formuliere eine kurze Zusammenfassung (1 Satz) der Kompetenzanforderung für ein Stellenprofil.",
        "Nutze aktive Verben und verzichte auf Füllwörter."],
    "CV-Kompetenzenabschnitt": [
        "Gib genau einen Bullet-Point zurück, der mit '- ' beginnt.",
        "Schreibe im Stil eines Lebenslauf-Stichpunkts (knapp, ergebnisorientiert)."],
    "Weiterbildungsberatung": [
        "Formuliere einen beratenden Satz, der eine Empfehlung ausspricht, welche Fähigkeiten gefördert werden sollen.",
        "Verwende eine freundliche, motivierende Tonalität."],
    "Suchanfrage für Fortbildungen": [
        "Formuliere eine kurze Suchanfrage, die mit 'Suche nach:' beginnt.",
        "Nutze relevante Schlüsselwörter und bleibe unter 160 Zeichen."],
    "Praxiserfahrung/Lehren aus beruflicher Erfahrung": [
        "Schreibe einen reflektierenden Satz in der Ich-Form.",
        "Hebe hervor, welches Ergebnis, Fähigkeit oder welche Erkenntnis erzielt wurde."],
}
NO_DESCRIPTION = "(keine Beschreibung verfügbar)"
NO_OCCUPATIONS = "(keine Angaben)"
NONE = "(keine)"
DASH = "—"
TASK, ORIGINAL, ESCO, JOBS = "\nAufgabe:", "\nOriginaltext:", "\nESCO-Beschreibung:", "\nVerwandte Berufe:"
COMPRESS = [
    "Kürze den folgenden Kurstext prägnant, ohne Inhalte zu erfinden.",
    "Übernimm Tonalität, Wortwahl und Satzbau des Originals so weit wie möglich und streiche nur überflüssige Passagen.",
    "Heb alle genannten Kompetenzen klar hervor.",
    "Nutze höchstens zwei Sätze im Präsens und bleibe sachlich.",
    "Vermeide Umschreibungen, Synonyme oder neue Beispiele.",
    "Verzichte auf Markdown, Aufzählungen oder Metakommentare.",
    "Gib ausschließlich den gekürzten Text zurück."]
CLUSTER = [
    "Gruppiere die folgenden Kompetenzen in semantisch unterscheidbare Cluster von maximal {n} Kompetenzen pro Gruppe.",
    "Jede Gruppe soll thematisch kohärent und von anderen Gruppen klar abgrenzbar sein.",
    "Verwende ähnliche oder überlappende Kompetenzen in derselben Gruppe.",
    "Trenne deutlich verschiedene Fachbereiche, Fertigkeiten oder Anwendungsgebiete in separate Gruppen.",
    "Gib die Gruppierung im folgenden JSON-Format zurück:",
    '{"groups": [{"labels": ["Kompetenz 1", "Kompetenz 2"]}, {"labels": ["Kompetenz 3", "Kompetenz 4"]}]}',
    "Verwende keine zusätzlichen Erklärungen oder Kommentare, nur das JSON-Objekt."]
GROUP_FIRST = "Schreibe eine stark verdichtete Fassung des Kurstextes in höchstens zwei kurzen Sätzen."
GROUP_FOCUS = ("Die Verkürzte Fassung sollte sich ausschließlich auf folgende angedeutete Kompetenzen fokussieren: ", ".")
GROUP_MIDDLE = ["Bewahre Tonalität, Perspektive und sachlichen Stil des Originaltextes.",
                "Fasse nur vorhandene Inhalte zusammen und erfinde keine neuen Aspekte."]
GROUP_AVOID = ("Erwähne keine der folgenden Kompetenzen oder Begriffe: ", ".")
GROUP_LAST = "Gib nur den verdichteten Text zurück."
ONE_TEXT = "Erzeuge genau einen kurzen deutschen Text (<= {n} Zeichen) und nutze höchstens zwei Sätze."
RARE_FOCUS = ("Der Text muss die Kompetenzen ", " klar hervorheben.")
RARE_STYLE = ("Verwende die Perspektive '", "' und passe den Stil an.")
RARE_FIXED = ["Formuliere natürlich, ohne Markdown, Aufzählungen oder Fettdruck.",
              "Der Satz soll als Trainingsbeispiel für semantische Suche dienen (prägnant, faktenorientiert)."]
RARE_AVOID = ("Erwähne auf keinen Fall: ", ".")
LAST = ["Gib nur den fertigen Text ohne zusätzliche Einordnung zurück.",
        "Vermeide Wiederholungen und halte den Text natürlich klingend."]
NEW_MANY = ("Du generierst Trainingsbeispiele für mehrere zusammenhängende Kompetenzen.",
            "Der Text muss alle folgenden Kompetenzen klar vermitteln: ", ".")
NEW_ONE = ("Du generierst Trainingsbeispiele für eine neue, bisher nicht abgedeckte Kompetenz.",
           "Der Text muss die Kompetenz '", "' eindeutig und sinnvoll vermitteln.")
NEW_STYLE = ("Verwende die Perspektive '", "' und passe den Stil entsprechend an.")
NEW_FIXED = ["Formuliere natürlich und praxisnah, ohne Markdown, Aufzählungen oder Fettdruck.",
             "Der Text soll als realistisches Trainingsbeispiel für semantische Suche dienen."]
NEW_TOGETHER = ("Die Kompetenzen sollten auf natürliche Weise zusammen erwähnt werden, "
                "wie sie in einem realen Kontext gemeinsam auftreten würden.")
NEW_AVOID = ("Erwähne auf keinen Fall diese anderen Kompetenzen: ", ".")
SKILLS = "\nKompetenz(en): "
# --------------------------------------------------------------------------------------------------


def _lines(*parts) -> Column:
    """Join lines; a null part is left out."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _around(pair, middle: Column) -> Column:
    return F.concat(F.lit(pair[-2]), middle, F.lit(pair[-1]))


def listed(labels: Column, empty: str = NONE) -> Column:
    """Sorted distinct non-empty labels in one line."""
    kept = F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull() & (x != ""))))
    return F.when(F.size(kept) > 0, F.array_join(kept, ", ")).otherwise(empty)


def guidance(scenario: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, lines in GUIDANCE.items():
        out = F.when(scenario == name, "\n".join(lines)).otherwise(out)
    return out


def some_occupations(occupations: Column, key: Column, seed: int = 42) -> Column:
    """Up to 3 occupations: all of them, or 3 in md5 order."""
    drawn = F.slice(F.array_sort(F.transform(occupations, lambda o: F.struct(hash_order(seed, key, o).alias("k"), o.alias("o")))), 1, 3)
    few = F.when(F.size(occupations) > 3, F.transform(drawn, lambda d: d.o)).otherwise(occupations)
    return F.when(F.size(few) > 0, F.array_join(few, ", ")).otherwise(NO_OCCUPATIONS)


def compress_prompt(text: Column, labels: Column) -> Column:
    return _lines(F.concat(F.lit("Kompetenzen: "), listed(labels)), TASK, *COMPRESS, ORIGINAL, text)


def cluster_prompt(labels: Column, n: int) -> Column:
    marked = F.array_join(F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("- "), x)), "\n")
    return _lines("Zu gruppierende Kompetenzen:", marked, TASK, CLUSTER[0].replace("{n}", str(n)), *CLUSTER[1:])


def group_char_limit(n_focus: Column, target_tokens: int) -> Column:
    return F.least(F.when(n_focus <= 2, 200).otherwise(260), F.lit(max(220, int(target_tokens * 0.8))))


def group_prompt(text: Column, focus: Column, avoid: Column) -> Column:
    some = F.size(F.filter(avoid, lambda x: x != "")) > 0
    return _lines(F.concat(F.lit("Fokus-Kompetenzen: "), listed(focus)),
                  F.concat(F.lit("Zu vermeidende Kompetenzen: "), listed(avoid)), TASK, GROUP_FIRST,
                  _around(GROUP_FOCUS, listed(focus)), *GROUP_MIDDLE,
                  F.when(some, _around(GROUP_AVOID, listed(avoid))), GROUP_LAST, ORIGINAL, text)


def rare_prompt(description: Column, occupations: Column, focus: Column, scenario: Column, avoid: Column,
                max_chars: int, key: Column) -> Column:
    some = F.size(F.filter(avoid, lambda x: x != "")) > 0
    return _lines(ESCO, F.coalesce(F.nullif(description, F.lit("")), F.lit(NO_DESCRIPTION)), JOBS, some_occupations(occupations, key), TASK,
                  ONE_TEXT.replace("{n}", str(max(150, max_chars - 100))),
                  F.concat(F.lit(RARE_FOCUS[0]), listed(focus), F.lit(RARE_FOCUS[1])), _around(RARE_STYLE, scenario),
                  *RARE_FIXED, guidance(scenario), *LAST, F.when(some, _around(RARE_AVOID, listed(avoid))))


def new_skill_prompt(description: Column, occupations: Column, positives: Column, scenario: Column, avoid: Column,
                     max_chars: int, key: Column) -> Column:
    some = F.size(F.filter(avoid, lambda x: x != "")) > 0
    many = F.size(positives) > 1
    first, last = F.slice(positives, F.lit(1), F.size(positives) - 1), F.element_at(positives, -1)
    named = F.when(many, F.concat(F.array_join(first, ", "), F.lit(" und "), last)).otherwise(F.element_at(positives, 1))
    return _lines(F.when(many, NEW_MANY[0]).otherwise(NEW_ONE[0]), F.concat(F.lit(SKILLS), named), ESCO,
                  F.coalesce(F.nullif(description, F.lit("")), F.lit(NO_DESCRIPTION)), JOBS, some_occupations(occupations, key), TASK,
                  ONE_TEXT.replace("{n}", str(max(150, max_chars - 100))),
                  F.when(many, _around(NEW_MANY, named)).otherwise(_around(NEW_ONE, named)), _around(NEW_STYLE, scenario),
                  *NEW_FIXED, F.when(many, NEW_TOGETHER), guidance(scenario), *LAST,
                  F.when(some, _around(NEW_AVOID, listed(avoid))))
