"""What a product costs, which plan to take, and how hot keys are split."""
