"""Scenarios of generated cases and how many statement variants they have."""

# Least and most variants by scenario.
SCENARIO_VARIANTS = {
    "if-else+caller": (3, 8),
    "if-else+orm": (4, 10),
    "switch": (5, 12),
    "dynamic_query": (6, 15),
    "fixed_params": (3, 6),
    "complex_control": (8, 20),
    "if-else+switch_mixed": (6, 15),
    "conditional_chain": (4, 10),
    "multi_branch_transaction": (2, 4),
    "state_machine_branch": (6, 14),
    "conditional_meta": (5, 12),
}
# Least and most variants by complexity.
LEVEL_VARIANTS = {"simple": (3, 6), "medium": (5, 10), "complex": (8, 15)}
