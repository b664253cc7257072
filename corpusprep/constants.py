"""Fixed values every operator agrees on."""

# Special tokens; the id of each is its position.
SPECIAL_TOKENS = ["<pad>", "<unk>", "<bos>", "<eos>", "<user>", "<assistant>", "<system>"]
PAD, UNK, BOS, EOS, USER, ASSISTANT, SYSTEM = range(7)

IGNORE_INDEX = -100

# Curriculum stages as (max_len, batch_size, perplexity threshold).
STAGES = [(256, 16, 50.0), (512, 8, 25.0), (1024, 4, 15.0)]
ACCUMULATION_STEPS = 8
VALIDATION_BATCH = 8
TRAIN_FRACTION = "0.95"

# Generation defaults.
SAMPLING_DEFAULTS = {
    "max_length": 200,
    "temperature": 0.7,
    "top_p": 0.9,
    "top_k": 50,
    "repetition_penalty": 1.1,
}
MAX_HISTORY_TOKENS = 2048

VOCAB_SIZE = 16000
MIN_FREQUENCY = 2

# Weights of the two assignment penalties.
BALANCE_WEIGHT = 0.01
Z_WEIGHT = 0.001
