"""Codes, versions and bounds that data must agree on. All are fixed values, in their declared order."""

from __future__ import annotations

PROMPT_VERSION, PACKET_VERSION, V1_VERSION, TAXONOMY_VERSION = "pre-research-2.0.0", "2.0.0", "1.0.0", "1.0.0"
MODEL_ID = "zai/glm-5.2"
TRANSCRIPT_BUCKET = "ai-engineer-transcripts"
MAX_DURATION_SECONDS = 5400

CATEGORIES = (
    "model_foundations_behavior", "inference_model_systems", "ai_data_engineering", "post_training_continual_learning", "prompting_llm_programming", "context_engineering_memory",
    "retrieval_search_knowledge", "agent_architecture_harnesses", "tools_protocols_integrations", "orchestration_durable_execution", "coding_agents_software_engineering",
    "evaluation_testing_benchmarking", "observability_reliability_llmops", "security_safety_identity_governance", "multimodal_realtime_systems", "ai_product_ux_human_factors", "ai_platforms_developer_tooling",
)
DOMAINS = (
    "frontier_model_lab", "applied_ai_research_lab", "cloud_ai_platform", "ai_compute_hardware_systems", "model_training_inference_platform", "ai_data_curation_training_platform",
    "database_data_ai_platform", "retrieval_knowledge_platform", "agent_framework_orchestration", "ai_developer_platform_sdk", "coding_agents_developer_tools", "evaluation_observability_llmops",
    "ai_security_identity_governance", "multimodal_voice_media_ai", "robotics_embodied_edge_ai", "enterprise_ai_automation", "horizontal_ai_application", "vertical_ai_application",
    "open_source_ai_ecosystem", "ai_protocol_standards_body", "academic_nonprofit_research", "ai_services_consulting", "ai_community_education_media", "ai_adopting_product_company",
    "general_technology_ai_unit", "diversified_technology_company", "other_unknown",
)
UNKNOWN_DOMAIN = "other_unknown"
DIFFICULTIES = ("introductory", "intermediate", "advanced", "expert")
CONTENT_FORMS = ("talk", "tutorial", "demo", "panel", "interview", "workshop", "keynote")
EVIDENCE_LEVELS = ("anecdotal", "case_study", "benchmarked", "production_system", "research_paper")
LIFECYCLE_STAGES = ("research", "design", "implementation", "evaluation", "deployment", "operations", "governance")
VERIFICATION = ("verified", "likely", "uncertain", "rejected")
EVIDENCE_SOURCES = ("transcript", "description", "web")
RESOURCE_TYPES = ("repository", "code_example", "documentation", "paper", "article", "slides", "dataset", "benchmark", "model", "demo", "course", "other")
ENTITY_KINDS = ("person", "organization", "product", "model", "protocol", "dataset", "benchmark", "paper", "repository", "other")
EVIDENCE_GRADES = ("said_in_transcript", "inferred_from_transcript", "verified_external", "unverified_external")
ORGANIZATION_SCOPES = ("independent_company", "parent_company", "subsidiary", "division", "research_lab", "product_organization", "standards_body", "academic_institution", "nonprofit", "community_education_media", "other")
PRIMARY_ROLE = "primary_featured_organization"
SOURCE_ROLES = (
    "official_homepage", "official_about", "official_product", "official_documentation", "official_research", "official_model_or_system_card", "official_repository", "official_engineering_blog",
    "official_changelog", "official_press_release", "regulatory_or_company_registry", "standards_specification", "conference_primary_material", "reputable_secondary_context",
)
IDENTITY_ROLES = ("official_homepage", "official_about", "regulatory_or_company_registry", "official_press_release")
TECHNICAL_ROLES = ("official_product", "official_documentation", "official_repository", "official_research", "official_model_or_system_card", "official_engineering_blog", "official_changelog", "standards_specification")
AUTHORITY_TIERS = ("first_party", "official_registry", "standards_body", "reputable_secondary")
AUTHORITATIVE_TIERS = ("first_party", "official_registry", "standards_body")
SUBAGENTS = ("organization_researcher", "web_context_scout", "source_verifier")

#: Artifact kinds and the files that hold them.
ARTIFACT_FILES = {
    "run_manifest": "00-run-manifest.json",
    "transcript_analysis": "10-transcript-analysis.json",
    "taxonomy_classification": "20-taxonomy-classification.json",
    "web_context": "30-web-context.json",
    "organization_research": "35-organization-research.json",
    "source_verification": "40-source-verification.json",
    "curriculum_signals": "50-curriculum-signals.json",
    "initial_summary": "initial-summary/60-initial-summary.json",
    "technology_library_summary": "technology-library-summary/70-technology-library-summary.json",
    "organization_profile": "organization-profile/80-organization-profile.json",
    "ingestion_intent": "90-ingestion-intent.json",
    "execution_receipt": "99-execution-receipt.json",
}
ARTIFACT_KINDS = tuple(ARTIFACT_FILES)
RESEARCH_KINDS, SYNTHESIS_KINDS, APPLY_KINDS = ARTIFACT_KINDS[:7], ARTIFACT_KINDS[7:11], ARTIFACT_KINDS[:11]

#: Operation kinds in the order an intent must have, and their tables.
OPERATION_TABLES = {
    "create_video_analysis": "research_video_analysis",
    "create_contextualized_initial_summary": "research_video_initial_summary",
    "replace_technology_library_summaries": "research_video_technology_summary",
    "replace_category_assignments": "research_video_category",
    "replace_domain_assignments": "research_video_domain",
    "replace_lifecycle_assignments": "research_video_lifecycle",
    "replace_evidence_anchors": "research_evidence_anchor",
    "replace_organization_candidates": "research_organization_candidate",
    "replace_organization_sources": "research_organization_source",
    "upsert_resource_candidates": "research_resource_candidate",
    "upsert_entity_candidates": "research_entity_candidate",
    "record_web_search_events": "research_web_search_event",
}
OPERATIONS = tuple(OPERATION_TABLES)
V1_OPERATIONS = ("create_video_analysis", "replace_category_assignments", "replace_domain_assignments", "replace_lifecycle_assignments", "upsert_resource_candidates", "upsert_entity_candidates", "replace_evidence_anchors", "record_web_search_events")

RUN_STATUSES = ("queued", "claimed", "analyzing", "research_complete", "synthesizing", "intent_ready", "applying", "applied", "review_required", "failed", "superseded")
#: A run in one of these keeps its video out of the queue; one in the others can be resumed.
OCCUPYING = ("queued", "claimed", "analyzing", "research_complete", "synthesizing", "intent_ready", "applying", "applied")
RESUMABLE = ("claimed", "analyzing", "research_complete", "synthesizing", "intent_ready", "applying", "applied", "review_required")
PIPELINE_LABELS = ("not_started", "eligible", "claimed", "researching", "research_complete", "synthesizing", "intent_ready", "review_required", "applying", "finalizing", "finished", "failed", "superseded")
TRANSITIONS = (
    ("queued", "claimed"), ("claimed", "analyzing"), ("analyzing", "research_complete"), ("research_complete", "synthesizing"), ("synthesizing", "intent_ready"), ("synthesizing", "review_required"),
    ("synthesizing", "research_complete"), ("intent_ready", "applying"), ("review_required", "applying"), ("applying", "applied"),
)
TERMINAL = ("applied", "failed", "superseded")

#: Reasons in reporting order, and the reason that is reported first for each group, by priority.
REASONS = (
    "transcript_status_not_stored", "transcript_text_empty", "transcript_bucket_invalid", "transcript_path_missing", "transcript_object_missing", "duration_missing", "duration_non_positive",
    "duration_at_or_over_5400_seconds", "already_live_for_current_transcript", "already_finished_for_current_transcript",
)
PRIMARY_REASONS = (
    ("TRANSCRIPT_NOT_STORED", ("transcript_status_not_stored", "transcript_text_empty")),
    ("TRANSCRIPT_OBJECT_MISSING", ("transcript_object_missing", "transcript_path_missing", "path_missing", "transcript_bucket_invalid", "bucket_invalid")),
    ("DURATION_MISSING", ("duration_missing",)),
    ("DURATION_INVALID", ("duration_non_positive",)),
    ("VIDEO_TOO_LONG", ("duration_at_or_over_5400_seconds",)),
    ("VIDEO_ALREADY_CLAIMED_OR_FINISHED", ("already_live", "already_finished", "already_live_for_current_transcript", "already_finished_for_current_transcript")),
)
OTHER_REASON = "VIDEO_INELIGIBLE"
