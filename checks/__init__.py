"""All checks by name."""

from checks import jobs, measures, reports, views

CHECKS = {**views.CHECKS, **measures.CHECKS, **jobs.CHECKS, **reports.CHECKS}

# Inventory entries that another entry already is, under their own names.
CHECKS.update({
    "a1_top_queries": CHECKS["v8_fact_top_queries"],
    "a2_wait_summary": CHECKS["v9_fact_wait_summary"],
    "a4_conditional_distinct": CHECKS["r15_server_comparison"],
    "j15_plan_star": CHECKS["r12_plan_instability"],
    "j16_plan_statistics": CHECKS["r13_plan_comparison"],
    "t3_top_ten_with_ties": CHECKS["k50_top_queries_count"],
    "u1_union_row_counts": CHECKS["r3_row_counts"],
    "u2_union_quality_checks": CHECKS["r16_data_quality"],
    "w6_duration_improvement": CHECKS["k51_duration_improvement"],
})
