"""Occupations as sets of broad categories, by keyword rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import null_if_blank, std_text

#: Specific occupations before general statuses; the first that a set holds is its primary one (fixed values).
PRIORITY = ("traditional_healer", "health", "miner", "security", "transport", "trade", "farmer", "artisan", "professional", "religious", "student", "housewife", "child", "none", "other")
#: Categories that a comparison ignores (fixed values).
IGNORED = ("child", "other")
#: Text that means unknown (fixed values).
UNKNOWN = r"^INC$|^INCONNU|^NSP$|^INDETERMIN|^NON (RENSEIGNE|PRECISE|SPECIFIE)|^SON (PERE|FRERE|MARI|ONCLE)|^SA (MERE|SOEUR|FEMME|TANTE)"
#: Flags of the second table and their categories (fixed values).
FLAGS = {"farmer": "farmer", "hunter": "farmer", "butcher": "trade", "business": "trade", "miner": "miner", "religiousleader": "religious", "housewife": "housewife", "student": "student", "child": "child", "traditional_healer": "traditional_healer", "transporter": "transport", "hcw": "health"}
#: Keywords of each category, as regular expressions over canonical text (fixed values).
RULES = {
    "child": (
        r"\bENFANTS?\b", r"\bEMFANT", r"NOURRIS", r"NOURIS", r"\bBEBE\b", r"NOUVEAU NE", r"NE PAR CESAR",
    ),
    "student": (
        r"\bELEVES?\b", r"\bELENE\b", r"\bENEVE\b", r"\bECOLIER", r"\bECILOI", r"ETUDIANT", r"EDUDIANT", r"APPRENTI",
        r"FINALISTE",
    ),
    "housewife": (
        r"MENAG|MENEG",
    ),
    "none": (
        r"SANS (PROFESSION|EMPLOI|METIER|OCCUPATION|TRAVAIL|ACTIVITE)", r"^SANS$", r"CHOMAGE", r"CHOMEUR", r"RETRAIT",
        r"VIEUIL", r"VIEILL", r"3EME AGE", r"^AUCUNE?$", r"^NEANT$", r"^RAS\b", r"DEBROUILL", r"^PATIENT$",
    ),
    "farmer": (
        r"CULTIV", r"CULTUV", r"COULTUV", r"CLTIV", r"CUTIV", r"AGRICULT", r"PLANTEUR", r"PANTEUR", r"ELEVEUR",
        r"ELEVAGE", r"PAYSAN", r"PECHEUR", r"\bPECHE\b", r"FORESTIER", r"BERGER", r"JARDI", r"\bFERME\b",
        r"EXPLOITANT", r"CHASSEUR", r"\bCHASSE\b", r"VIANDE DE BROUSSE", r"CONVOYEUR DE BOEUFS",
    ),
    "miner": (
        r"MINEUR", r"MINIER", r"\bMINES?\b", r"ORPAIL", r"OR PAIL", r"ORPALL", r"CREUSEUR", r"CRESEUR",
        r"CASSEUR DE PIERRE", r"CANCEUR DES PIERRES", r"CONCASSEUR", r"COCASS", r"CARRIER",
    ),
    "trade": (
        r"COMMER", r"COMER", r"COMMEC", r"VENDEU", r"VENSEU", r"VANDEU", r"MARCHAND(?!ISE)", r"MARCHANT",
        r"FOURNISSEUR", r"BOUTIQU", r"REVENDEU", r"AMBULANT", r"NEGOCIANT", r"BOUCHER", r"DETAILLANT", r"\bVENTE\b",
        r"ACHETEUR", r"ACHETREUR", r"BRAISEUR", r"FRIPERIE",
    ),
    "transport": (
        r"CHAUFFEUR", r"CHAFFEUR", r"MOTARD", r"\bMOTAR\b", r"TAXI", r"TRANSPORT", r"CONVOYEUR VEHICULE", r"TSHUKUD",
        r"CHUKUD", r"AMBULANCI", r"CHARETIER", r"CHARRETIER", r"POIDS? LOUR", r"CAMION", r"AVIATEUR",
    ),
    "artisan": (
        r"COUTUR", r"COUTIR", r"CUTURI", r"TAILLE+U", r"CHARPENT", r"CHARPANT", r"MACON", r"MANCON", r"MENUIS",
        r"MENUSI", r"MENOU", r"PEINTR", r"PINTRE", r"MECANIC", r"MACHINIST", r"COIFF", r"CLOIFF", r"\bTRESS",
        r"TRAISS", r"DRESSEUSE", r"ELECTRIC", r"ELECTRONIC", r"ELECTROMEC", r"MANUTENT", r"MANUTATION", r"MANITATION",
        r"MANUNTENT", r"BOMBEU", r"FORGERON", r"CORDONN", r"CORDONI", r"COORDONN", r"COORDONI", r"COODONN", r"PLOMBI",
        r"SOUDEU", r"LAVEUR", r"LAVADEUR", r"LAVADIER", r"JOURNALIER", r"OUVRIER", r"MANOEUVRE", r"BOULANG",
        r"PATISS", r"CUISINI", r"SERVEU", r"SERVENTE", r"RESTAURANT", r"HOTELI", r"DOMESTIQUE", r"REPARAT",
        r"TOU[ST] TRAV", r"PETITS? TRAVAUX", r"SCIEUR", r"PRESSEUR", r"BRIQUE", r"FERRAIL", r"FERAILL", r"FERRAY",
        r"POMPISTE", r"VITRIER", r"VERNISS", r"ARTISAN", r"ARTISTE", r"MUSICIEN", r"SCULPT", r"DECORAT",
        r"PHOTOGRAPH", r"IMPRIMEUR", r"CONSTRUCT", r"CARREL", r"CANTONI", r"CANTONN", r"BOULONN",
        r"TECHNICIEN(?![A-Z ]*LABO)", r"MAINTENANC", r"MEUNIER", r"MENIER", r"MOULIN", r"USINE", r"TRIEUSE",
        r"TRILLEUSE", r"CHIMISTE", r"SALONNEUR", r"SPORTIF", r"FOOTBALL", r"BOXEUR", r"BASKET", r"KARAT", r"DANSEUSE",
        r"CLEANER", r"ENTRETIEN", r"FABRICANT",
    ),
    "health": (
        r"SANTE", r"SANITAIRE", r"INVESTIGAT", r"INFIRM", r"INFIEM", r"INFIRL", r"\bMEDECINS?\b(?! TRADI)", r"MEDCIN",
        r"PHARMAC", r"DOCTEUR", r"HYGIEN", r"HIGIEN", r"LABO", r"PHARMACIEN", r"SOIGNANT", r"SAGE FEMME",
        r"ACCOUCHEU", r"RIPOSTE", r"\bEDS\b", r"\bCTE?\b", r"\bRECO\b", r"RELAIS COMM", r"\bPCI\b", r"\bPCT\b",
        r"\bHP\b", r"\bAPS\b", r"\bPEC\b", r"\bPOE\b", r"\bIDR\b", r"PSYCHO", r"PSYCOLOG", r"NUTRITIONN?IST",
        r"AMBULANC", r"SECOURISTE", r"CROIX ROUGE", r"TRIAGE", r"SURVEILLANCE", r"RECHERCHE ACTIVE", r"VACCINAT",
        r"PRELEVEMENT", r"OPHTA", r"ANESTH", r"ANSTHE", r"DENTISTE", r"\bP E C\b", r"KINESI",
        r"PROMOTION DE LA SANTE", r"POINT D ENTREE", r"BERCEUSE", r"GARDE MALADE", r"ACCOMPAGNANT", r"FILLE DE SALLE",
    ),
    "traditional_healer": (
        r"TRADI ?PRA", r"\bTRADI\b", r"MEDECIN TRADI", r"COUTUMI", r"GUERISSEUR", r"FETICHEUR", r"HERBORIST",
    ),
    "religious": (
        r"PASTEUR", r"PRETRE", r"RELIGI", r"EVANG", r"CHANTRE", r"DIACRE", r"EGLIS", r"PAROISSE", r"PASTORAL",
        r"CATECH", r"\bIMAM\b", r"MOSQUEE", r"\bFIDELE\b", r"REVERE",
    ),
    "security": (
        r"MILIT", r"MILLIT", r"POLIC", r"FORCES? DE SECU", r"FORCES? DE L ORDRE", r"SECURIT", r"SECUTIT", r"SECURIS",
        r"GARDIEN", r"GARDIENT", r"GARDIENAGE", r"GARDIENNAGE", r"SENTIN", r"SANTIN", r"DENTINELLE", r"\bANR\b",
        r"FARDC", r"COMBATTANT", r"MAIMAI", r"MAI MAI", r"SOLDAT", r"ARMEE", r"POMPIER", r"RENSEIGNEMENT", r"PORTIER",
    ),
    "professional": (
        r"\bENSEIG", r"\bESEIGN", r"PROF+ESSEUR", r"INSTITUTEUR", r"MAITRESSE", r"DIRECTEUR", r"PREFET",
        r"INSPECTEUR", r"FONCTION", r"AGENT DE L ?ETAT", r"EGENT DE L ETAT", r"ADMINISTRAT", r"SECRETAIRE",
        r"SECRETAIRE", r"COMPTABLE", r"RECEPTION", r"INFORMATICI", r"JOURNALIST", r"AVOCAT", r"\bJUGE\b", r"JURISTE",
        r"HUISSIER", r"INGENIEUR", r"INGENIERE", r"ARCHITECTE", r"ARCHIVISTE", r"AGRONOME", r"LOGISTICIEN",
        r"DATA MANAGER", r"\bONG\b", r"HUMANITAI", r"OXFAM", r"MONUSCO",
        r"CHEF( FE)?( DE| DU)? (QUARTIER|VILLAGE|CELLULE|GROUPEMENT|NOTAB|TERRIEN|TRADITION|COUTUM|D ENTENE)",
        r"NOTABLE", r"NOTABILITE", r"DOUANE", r"DOUANNE", r"\bDGDA\b", r"\bDGI\b", r"REGIE", r"\bRVA\b", r"\bSNEL\b",
        r"SODEICO", r"OFFICE DE ROUTE", r"TRANSCOM", r"\bEPSP\b", r"DIVISION", r"MAIRIE", r"TAXATEUR", r"PERCEPTEUR",
        r"CONTROLEUR", r"COMMISSAIRE", r"DECLARANT", r"VERIFICATEUR", r"ETAT CIVIL", r"ENVIRON", r"TOURISME",
        r"CONSULTANT", r"ENTREPREN", r"LIBERALE", r"ACTIVISTE", r"ANIMATEUR", r"SUPERVISEUR", r"TEAM LEADER",
        r"COORDINAT", r"COMMUNICATION", r"COMMUNICOLOGUE", r"POINT FOCAL", r"SOUS DIVISION", r"EXPATRI",
        r"VETERINAIRE", r"GERANT",
    ),
}


def from_text(c: Column) -> Column:
    """Sorted categories; other where text is there but no rule knows it; empty for null and unknown."""
    none = F.array().cast("array<string>")

    def categories(s: Column) -> Column:
        hits = F.array_sort(F.filter(F.array(*[F.when(s.rlike("|".join(words)), F.lit(k)) for k, words in RULES.items()]), lambda x: x.isNotNull()))
        return F.when(s.isNull() | s.rlike(UNKNOWN), none).otherwise(F.transform(F.array(hits), lambda x: F.when(F.size(x) == 0, F.array(F.lit("other"))).otherwise(x))[0])

    return F.get(F.transform(F.array(std_text(c)), categories), F.lit(0))  # as a member of an array, the text is made canonical once


def from_flags(flags: dict[str, Column], other: Column, detail: Column) -> Column:
    """Categories of the flags that are set and of the detail text; other only where nothing else is known."""
    own = F.filter(F.array(*[F.when(F.coalesce(flags[k], F.lit(False)), F.lit(v)) for k, v in FLAGS.items()]), lambda x: x.isNotNull())
    cats = F.array_union(own, from_text(detail))
    unknown = F.coalesce(std_text(detail).rlike(UNKNOWN), F.lit(False))
    cats = F.when((F.size(cats) == 0) & F.coalesce(other, F.lit(False)) & ~unknown, F.array(F.lit("other"))).otherwise(cats)
    return F.array_sort(F.when(F.size(cats) > 1, F.array_remove(cats, "other")).otherwise(cats))


def primary(cats: Column) -> Column:
    return F.get(F.filter(F.array(*map(F.lit, PRIORITY)), lambda p: F.array_contains(cats, p)), F.lit(0))


def as_string(cats: Column) -> Column:
    return null_if_blank(F.array_join(cats, "|"))


def compared(cats: Column) -> Column:
    return F.array_except(cats, F.array(*map(F.lit, IGNORED)))
