"""Models: staging, facts, marts, context chunks and prompts."""
