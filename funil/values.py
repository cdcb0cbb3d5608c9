"""Names and literals a caller of the original data model relies on."""

# Lead temperature tags, and the tag a new lead gets when none is given.
TAG_HOT = "lead_quente"
TAG_WARM = "lead_morno"
TAG_COLD = "lead_frio"
TAG_NEW = "novo_lead"

# Subscription tier a provider gets when none is given.
DEFAULT_TIER = "basico"

# Sender labels: for auditing, and as chat roles for a model's context.
SENDER_ASSISTANT = "AGENTE_IA"
SENDER_LEAD = "LEAD"
ROLE_ASSISTANT = "assistant"
ROLE_USER = "user"

# Defaults of the history lookup and of the snapshots.
HISTORY_LIMIT = 50
RETENTION_DAYS = 7
MIN_SNAPSHOT_BYTES = 5 * 1024

# Keys a bot configuration carries.
CONFIG_KEYS = (
    "modelo",
    "max_tokens",
    "temperatura",
    "prompt_sdr",
    "prompt_boas_vindas",
    "horario_atendimento",
    "webhook_n8n",
    "chatwoot_inbox_id",
)
