"""The models: staging, intermediate, dimensions, facts, profile, metrics, serving."""
