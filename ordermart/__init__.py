"""Order mart and review-risk features on Spark."""
