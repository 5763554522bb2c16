"""Fixed values.

Everything in this module is part of the observable result (rule names, alert
texts, patterns, prompt texts, the digit law), so it is written down once, as
it must appear in the output, and used from here.
"""

# --- Fixed values: extraction tiers, best first --------------------------------
VLM = "vlm"
VLM_RETRY = "vlm_retry"
OCR_LLM = "ocr_llm"
OCR_LLM_RETRY = "ocr_llm_retry"
REGEX_FALLBACK = "regex_fallback"
EXTRACTION_METHODS = [VLM, VLM_RETRY, OCR_LLM, OCR_LLM_RETRY, REGEX_FALLBACK]

# --- Fixed values: alert levels and rules, in report order ---------------------
OK = "ok"
WARNING = "warning"
CRITICAL = "critical"
LEVELS = [OK, WARNING, CRITICAL]

ARITHMETIC_LINES = "arithmetic_lines"
ARITHMETIC_TTC = "arithmetic_ttc"
HASH_DUPLICATE = "hash_duplicate"
SEMANTIC_DUPLICATE = "semantic_duplicate"
NEAR_DUPLICATE = "near_duplicate"
ZSCORE = "zscore"
ISOLATION_FOREST = "isolation_forest"
BENFORD = "benford"

# --- Fixed values: alert texts ---------------------------------------------------
DETAIL_LINES = "Somme lignes ({line_sum:.2f}) vs total ({reference:.2f})"
DETAIL_TTC = "HT+TVA ({expected_ttc:.2f}) != TTC ({total_ttc:.2f})"
DETAIL_HASH = "Doublon exact detecte (hash={hash}...)"
DETAIL_SEMANTIC = "Doublon semantique (sim={similarity:.3f}, fournisseur={fournisseur}, ttc={total_ttc})"
DETAIL_NEAR = "Facture tres similaire (sim={similarity:.3f})"
DETAIL_ZSCORE = "Z-score={z:.1f} (moy={mu:.2f}, sigma={sigma:.2f})"
DETAIL_FOREST = "Anomalie multivariee (IF score={decision:.3f})"
DETAIL_BENFORD = "chi2={chi2}, p={pvalue}"

# --- Fixed values: image file extensions ----------------------------------------
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "tif", "tiff", "bmp"]

# --- Fixed values: patterns of the regex tier -------------------------------------
DATE_DAY_FIRST = r"(\d{2}[/\-\.]\d{2}[/\-\.]\d{4})"
DATE_YEAR_FIRST = r"(\d{4}[/\-\.]\d{2}[/\-\.]\d{2})"
AMOUNT = r"(\d+[.,]\d{2})"
LINE_WITH_AMOUNT = r"(.{2,40}?)\s+(\d+[.,]\d{2})\s*$"
NOT_A_LINE = r"(total|subtotal|tax|change|cash|tendered|amount|gst|round)"

# --- Fixed values: model answers ----------------------------------------------------
CODE_FENCE = "```"
DECISION_MARK = "DECISION:"
RETRY_SCHEMA_ERROR = "Structure JSON non conforme au schema attendu"
RETRY_OCR_ERROR = "JSON invalide"
RETRY_PARSE_ERROR = "JSON invalide"
RETRY_OCR_TEXT = "\nTexte original:\n"

# --- Fixed values: prompt texts sent to the models -----------------------------------
# The extraction prompt is sent as it stands, doubled braces included.
EXTRACTION_PROMPT = """Tu es un systeme d'extraction de donnees de factures.
Analyse cette image de facture et retourne UNIQUEMENT un JSON valide.
Si un champ est illisible ou absent, utilise null.
Les montants doivent etre des nombres decimaux sans symboles.

SCHEMA JSON :
{{"numero_facture": "string ou null", "fournisseur": "string ou null",
"date_facture": "string ou null",
"lignes": [{{"designation": "string", "quantite": number, "prix_unitaire": number, "total_ligne": number}}],
"total_ht": number ou null, "tva_taux": number ou null,
"tva_montant": number ou null, "total_ttc": number ou null}}

JSON :"""

RETRY_PROMPT = """Le JSON que tu as produit a echoue la validation :
ERREUR : {error}

Corrige le JSON et retourne UNIQUEMENT le JSON corrige, sans texte avant ni apres.
JSON corrige :"""

OCR_PROMPT = """Tu es un systeme d'extraction de donnees de factures.
Retourne UNIQUEMENT un JSON valide. Si un champ est absent, utilise null.

SCHEMA : {{"numero_facture": str, "fournisseur": str, "date_facture": str,
"lignes": [{{"designation": str, "quantite": float, "prix_unitaire": float, "total_ligne": float}}],
"total_ht": float, "tva_taux": float, "tva_montant": float, "total_ttc": float}}

TEXTE OCR :
{ocr_text}

JSON :"""

FRAUD_PROMPT = """Tu es un expert en fraude documentaire. Analyse cette facture :

DONNEES EXTRAITES :
- Fournisseur : {fournisseur}
- Date : {date}
- Total HT : {total_ht}
- TVA : {tva_montant}
- Total TTC : {total_ttc}
- Nombre de lignes : {nb_lignes}
- Methode d'extraction : {method}

ALERTES DECLENCHEES :
{alerts}

Raisonne etape par etape :
1. Les montants sont-ils coherents ?
2. Y a-t-il des indices de doublon ou de manipulation ?
3. Quelle est la probabilite de fraude (0-100%) ?

Conclus avec exactement : DECISION: [APPROVE|REVIEW|BLOCK] - RAISON: [explication courte]"""
